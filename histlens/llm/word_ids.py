"""Token ids of whole texts with a tokenizer file, with a memory of words (inside tasks).

The text is cut at ASCII white space, and between a letter a-z and the comma or stop that ends a
word; the tokenizer itself always cuts there, so that the ids of the parts joined are the
ids of the text.  That holds for tokenizers whose pre-tokenizer drops white space, lower-cases and splits
letters from punctuation, with byte-level letters (word_bpe_49k.json).  A word of letters alone is one
pre-token and goes to the tokenizer's model directly, in the model's letters for bytes.  A file whose normaliser,
pre-tokenizer or model is another one is recognised, and its texts are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re
from unicodedata import is_normalized

import numpy as np

END_ID = 1
# what a file must say for its texts to be cut into words
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_into_words(spec: dict) -> bool:
    """Whether a tokenizer file lower-cases, drops white space and splits letters from punctuation as this module does."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    steps = pre.get("pretokenizers") or [{}]
    return (spec.get("normalizer") == _NORMALIZER and pre.get("type") == "Sequence" and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and steps[0].get("pattern") == {"Regex": _SPLIT} and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
            and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex") and model.get("type") == "BPE" and not model.get("dropout")
            and all(t["content"].startswith("<|") for t in spec.get("added_tokens") or []))


_PLAIN = re.compile(rb"[a-z]+").fullmatch


def _byte_letters() -> list[str]:
    """The letter that byte-level tokenizers use for each byte: printable Latin-1 as itself, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordIds(dict):
    """Callable: UTF-8 texts to their ids as little-endian unsigned 32-bit bytes; itself the memory of words."""

    LIMIT = 300_000                 # words remembered before the older half goes

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.by_words = cuts_into_words(json.load(f))
        self.model = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, w: bytes) -> bytes:
        got = self.old.get(w)
        if got is None:
            if _PLAIN(w):
                got = np.array([t.id for t in self.model(w.decode())], "<u4").tobytes()
            elif w[-1:] in (b",", b".") and w[-2:-1].isalpha():          # bytes: isalpha is a-z A-Z
                got = self[w[:-1]] + self[w[-1:]]
            else:
                got = self._other(w.decode())
        self[w] = got
        return got

    def _other(self, s: str) -> bytes:
        low = s.lower() if "Σ" not in s else ""         # its lower case depends on its place
        if low.isalpha() and is_normalized("NFC", s):
            ids = [t.id for t in self.model("".join([self.letters[b] for b in low.encode()]))]
        else:
            ids = self.tokenizer.encode(s, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_words:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
        if len(self) > self.LIMIT:
            self.old = dict(self)
            self.clear()
        # special tokens are matched as written
        return [b"".join(map(self.__getitem__, (t.lower() if b"<|" not in t else t).split())) for t in texts]

    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)
