"""Language identification by compression.

Each language has one zstandard raw-content dictionary: whole training texts
of that language, lower-cased.  A text is compressed with every dictionary
and the language of the smallest result is chosen.  The score is the relative
saving against the runner-up, scaled to 0..1; texts whose saving is below
``margin`` can be rejected.

The dictionaries are fitted on a bounded sample (``DOCS_PER_LANG`` whole texts a
language, chosen by a hash of the id, ``DICT_BYTES`` bytes at most); every whole
text is compressed, piece by piece, and the sizes of its pieces add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlens.llm.common import byte_texts, forget_kept, hash_sample, slices, train_rows, with_text

DOCS_PER_LANG = 100                 # training texts of one language
DOC_CHARS = (300, 4000)             # their lengths
DICT_BYTES = 100_000
LEVEL = 6
PIECE = 1024                        # bytes compressed at a time, so that a long text's own repeats don't hide its language
MARGIN = 0.002                      # rejected below this saving
_LETTER = regex.compile(rb"[A-Za-z]")
_ANY_LETTER = regex.compile(r"\p{L}")

Model = list[tuple[str, bytes]]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """(language, dictionary content) per language of the training rows, in the order of names.

    Learns only from rows with a language and crc32(id) mod 5 <> 0.  The sample
    that reaches the driver has at most DOCS_PER_LANG texts of DOC_CHARS[1]
    characters a language; a language without texts of such length gives whatever
    shorter or longer ones it has (cut to DICT_BYTES).
    """
    n = F.length(text_col)
    rows = (docs.filter(train_rows(F.col(id_col)) & F.col(lang_col).isNotNull() & (n > 0))
            .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                    (~n.between(*DOC_CHARS)).cast("int").alias("odd"), F.xxhash64(id_col, text_col).alias("h")))
    pick = Window.partitionBy("lang").orderBy("odd", F.pmod("h", F.lit(1 << 31)), "h")
    got = hash_sample(rows, ["lang", "odd"], "h", DOCS_PER_LANG).withColumn("k", F.row_number().over(pick)).filter(F.col("k") <= DOCS_PER_LANG)
    got = got.withColumn("text", F.when(F.col("odd") == 1, F.substring("text", 1, DOC_CHARS[1])).otherwise(F.col("text")))
    held: dict[str, list[bytes]] = {}
    for r in got.orderBy("lang", F.desc("k")).collect():        # the best matches stand at a dictionary's end
        held.setdefault(r.lang, []).append(r.text.lower().encode())
    return [(lang, b"\n".join(ts)[-DICT_BYTES:]) for lang, ts in sorted(held.items())]


class Classifier:
    def __init__(self, model: Model):
        self.langs = [lang for lang, _ in model]
        self.tools = []
        for _, content in model:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, text: bytes) -> tuple[str, float, float]:
        """(language, score, saving); und without a letter or a model."""
        if not self.langs or not (_LETTER.search(text) or _ANY_LETTER.search(text.decode("utf-8", "replace"))):
            return "und", 0.0, 0.0
        low = text.decode("utf-8", "replace").lower().encode()
        pieces = [low[i : i + PIECE] for i in range(0, len(low), PIECE)]
        sizes = sorted((sum(len(c.compress(p)) for p in pieces), lang) for c, lang in zip(self.tools, self.langs))
        saving = 1.0 if len(sizes) == 1 else (sizes[1][0] - sizes[0][0]) / max(1, sizes[1][0])
        return sizes[0][1], min(1.0, 5 * saving), saving


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str | Column, ...] = (), margin: float = MARGIN) -> DataFrame:
    """``keep`` columns, lang_pred, score, rejected: one row per document.

    Null, empty and letterless texts are ``und`` with score 0 and rejected; so is every
    text if the model has no language.  Ties go to the smaller language name
    and have score 0.  A text is also rejected if its saving is below ``margin``.
    """
    src, text = with_text(docs, keep, text_col)
    n = len(keep)
    out = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:n]) + "lang_pred string, score double, rejected boolean"
    shared = docs.sparkSession.sparkContext.broadcast(model)      # at most DICT_BYTES a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        judge = Classifier(shared.value)
        for b in slices(batches):
            got = [judge(t) for t in byte_texts(b, text)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[0] == "und" or g[2] < margin for g in got], pa.bool_())],
                [*b.schema.names[:n], "lang_pred", "score", "rejected"])
    return src.mapInArrow(run, out)
