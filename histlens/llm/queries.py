"""The queries of this subpackage over the driver's tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlens.llm import (
    bitpack, block_dedup, collocations, hilbert_ann, html_layout, line_rules, ngram_join, quality_bt, sp_suffix, token_align, url_filter, vector_pack,
    zstd_lang,
)
from histlens.llm.common import train_rows

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ngram_join(spark, sf_dir):
    rows = block_dedup.with_rid(table(spark, sf_dir, "documents"), "doc_id", "text")
    return ngram_join.near_duplicates(rows).select("doc_id", "n_shingles", "component_id")


def op2_hilbert_ann(spark, sf_dir):
    return hilbert_ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_token_files(spark, sf_dir):
    return bitpack.token_table(table(spark, sf_dir, "documents"), tokenizer_path()).drop("pos")


def op4_sentencepiece(spark, sf_dir):
    return sp_suffix.encode_table(table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op5_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("p_block")


def op6_packing(spark, sf_dir):
    return vector_pack.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_bt.fit(docs, table(spark, sf_dir, "labels"))
    return quality_bt.score(docs, model, keep=("doc_id", (~train_rows(F.col("doc_id"))).alias("held_out")))


def op8_html_layout(spark, sf_dir):
    return html_layout.extract(table(spark, sf_dir, "pages"))


def op9_exact_dedup(spark, sf_dir):
    rows = block_dedup.with_rid(table(spark, sf_dir, "documents"), "doc_id", "text")
    return block_dedup.exact_groups(rows).drop("rid")


def op10_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = zstd_lang.identify(docs, zstd_lang.fit(docs), keep=("doc_id", (~train_rows(F.col("doc_id"))).alias("held_out")))
    return found.drop("rejected")


def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_alignment(spark, sf_dir):
    return token_align.align(table(spark, sf_dir, "documents"), tokenizer_path(BYTES), tokenizer_path(PIECES))[0]


def op13_quality_rules(spark, sf_dir):
    return line_rules.judge(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""
OP9_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
           FROM documents),
g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256
FROM t JOIN g ON t.x = g.x
"""
OP11_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
inside AS (SELECT lang, unnest([array_to_string(w[i : i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase, a AS most
           FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2)),
own AS (SELECT f.* FROM f LEFT JOIN (SELECT lang, phrase, max(most) AS most FROM inside GROUP BY ALL) i ON i.lang = f.lang AND i.phrase = f.phrase
        WHERE k > 1 AND (most IS NULL OR 100 * most < 100 * a)),
cuts AS (SELECT lang, phrase, a, j, array_to_string(w[1 : j], ' ') AS left_part, array_to_string(w[j + 1 :], ' ') AS right_part
         FROM (SELECT *, unnest(range(1, k)) AS j FROM own)),
scored AS (SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, j,
                  CAST((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = left_part JOIN f y ON y.lang = c.lang AND y.phrase = right_part
           JOIN totals t ON t.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
OP13_SQL = r"""
WITH words AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
                      list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
lines AS (SELECT doc_id, host, unnest(range(1, len(raw) + 1)) AS i, unnest(raw) AS line FROM (SELECT *, string_split(t, chr(10)) AS raw FROM words)),
norm AS (SELECT *, array_to_string(lw, ' ') AS key, len(lw) AS size FROM (SELECT *, list_filter(regexp_split_to_array(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS lw FROM lines) WHERE len(lw) > 0),
dups AS (SELECT doc_id, sum(c - 1) AS n_dup_lines FROM (SELECT doc_id, line, count(*) AS c FROM norm GROUP BY ALL) GROUP BY doc_id),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
texts AS (SELECT doc_id, host, list(key ORDER BY i) AS id FROM norm GROUP BY ALL
          UNION ALL SELECT doc_id, host, [] FROM words WHERE len(w) = 0),
distinct_texts AS (SELECT DISTINCT host, id FROM texts),
hosts AS (SELECT host, count(*) AS docs FROM distinct_texts GROUP BY host),
often AS (SELECT d.host, key FROM (SELECT host, unnest(list_distinct(id)) AS key FROM distinct_texts) d JOIN hosts h ON h.host = d.host
          GROUP BY d.host, key, docs HAVING count(*) > 20 AND 100 * count(*) > docs),
lost AS (SELECT doc_id, sum(size) AS n_lost FROM norm JOIN often USING (host, key) GROUP BY doc_id),
measured AS (SELECT doc_id, len(w) AS n_words, list_sum(list_transform(w, lambda x: len(x))) AS chars,
                    len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM words),
judged AS (SELECT m.doc_id, n_words, coalesce(chars, 0)::BIGINT AS word_chars, n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
                  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lost, 0)::BIGINT AS n_lost_words
           FROM measured m LEFT JOIN dups d ON d.doc_id = m.doc_id LEFT JOIN repeats r ON r.doc_id = m.doc_id LEFT JOIN lost l ON l.doc_id = m.doc_id)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR (n_lost_words > 0 AND (100 * n_lost_words > 50 * n_words OR n_words - n_lost_words < 20))) AS kept
FROM judged
"""


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_hilbert_ann": op2_hilbert_ann,
        "op3_token_files": op3_token_files,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_url_filter": op5_url_filter,
        "op6_packing": op6_packing,
        "op7_quality": op7_quality,
        "op8_html_layout": op8_html_layout,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_language": op10_language,
        "op11_collocations": op11_collocations,
        "op12_alignment": op12_alignment,
        "op13_quality_rules": op13_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_join": OP1_SQL, "op9_exact_dedup": OP9_SQL, "op11_collocations": OP11_SQL, "op13_quality_rules": OP13_SQL}
