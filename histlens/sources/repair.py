"""D1: repair CSV files whose text fields contain commas and line breaks.

Contract (per stream of lines in file order): drop ``\\r`` and ``\\t``; a line
whose right-trimmed text ends in ``;`` has every ``,`` turned into ``;``;
lines are concatenated until the text holds at least two commas; a record
needs three or more: ``id`` = before the first comma, ``who`` = after the
last, ``when`` = after the last but one, ``what`` = the rest with ``,`` -> ``;``.
Texts with fewer commas go to the rejects (reason ``no comma``,
``unfinished`` or ``two commas``).

Parallel form.  The buffer is either empty or holds exactly one comma, so a
line with >= 2 commas always closes a record, and the buffer state before a
line is the parity of the one-comma lines since the last closing line.  That
is a prefix computation: windows inside each block (a file split), a carry over
per-block summaries in two levels (ranges of blocks, then the ranges), then an
aggregation by record key (the position of the record's opening line), first the
lines of one block, then the blocks.  No stream passes through one task.

The cleaned lines are stored once and read by all steps.  A record's lines of one block are a
piece.  Its first line holds its first comma and, of a record with three commas, its last line the last two: id comes from
the first piece, when and who from the last, whatever lies between.  text and what are the pieces on
end; a damaged file can open a record that takes all following lines, and where they are more than a column's value
can hold (``MAX_VALUE`` bytes), text and what are NULL and ``record_pieces`` has them piece by piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histlens.operators.prefix import stored_in_order
from histlens.sources.store import materialise

STREAM = "_stream"
BLOCK_LINES = 1 << 14                   # lines of a file that one window sees
MAX_VALUE = (1 << 31) - (1 << 24)       # bytes that one value of a column can hold, with room for its neighbours

# --- fixed values: white space removed by a right trim (the characters a
# Python ``str.rstrip()`` strips), as one regex class valid in Java and RE2 --
TRAILING_SPACE = ("[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
                  "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+$")


def clean_line(line: Column) -> Column:
    t = F.regexp_replace(line, "[\\r\\t]", "")
    ends_semi = F.regexp_replace(t, TRAILING_SPACE, "").endswith(";")
    return F.when(ends_semi, F.replace(t, F.lit(","), F.lit(";"))).otherwise(t)


def count_commas(t: Column) -> Column:
    return F.length(t) - F.length(F.replace(t, F.lit(","), F.lit("")))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as ``(file, block, ln, line)``: the file split and the read
    order inside it define line order (only defined within one file)."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("ln"),
        F.col("value").alias("line"))


def _keyed(lines: DataFrame, s: list[str], block_col: str, o: list[str], line_col: str, folder: str | None) -> DataFrame:
    """The cleaned lines (_t, commas _k) with their position and _key, the position of their record's first line."""
    t = clean_line(F.col(line_col))
    x = lines.select(*s, block_col, *o, t.alias("_t")).withColumn("_k", count_commas(F.col("_t")))
    x = materialise(x, "lines", folder and f"{folder}/lines")
    x = (x.withColumn("_c", F.least(F.col("_k"), F.lit(2)))
         .withColumn("_pos", F.struct(F.col(block_col).alias("b"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(o)])))
    unb = Window.unboundedPreceding
    one = (F.col("_c") == 1).cast("int")
    term = (F.col("_c") == 2).cast("int")

    # 1. inside each block, in one sorted pass: closing lines before, one-comma lines since the last one
    # (those before a line less those before the last closing line, both of which only grow)
    wb = Window.partitionBy(*s, block_col).orderBy(*o).rowsBetween(unb, -1)
    x = (x.withColumn("_seg", F.coalesce(F.sum(term).over(wb), F.lit(0)))
         .withColumn("_ones", F.coalesce(F.sum(one).over(wb), F.lit(0)))
         .withColumn("_op", F.max(F.when(F.col("_c") == 1, F.col("_pos"))).over(wb)))
    at_term = F.max(F.when(F.col("_c") == 2, F.col("_ones")))
    x = x.withColumn("_n1", F.col("_ones") - F.coalesce(at_term.over(wb), F.lit(0)))

    # 2. carry between blocks, from per-block summaries (one row per block)
    blocks = x.groupBy(*s, block_col).agg(
        F.sum(term).alias("_nt"), F.sum(one).alias("_n1_all"), at_term.alias("_done"),
        F.max(F.when(F.col("_c") == 1, F.col("_pos"))).alias("_l1"))
    blocks = blocks.select(*s, block_col, (F.col("_nt") > 0).cast("int").alias("_t"),
                           (F.col("_n1_all") - F.coalesce("_done", F.lit(0))).alias("_n"), "_l1")
    blocks = stored_in_order(blocks, [*s, block_col], "blocks", folder=folder)
    inner = _carry(blocks, ["_pid", *s], "_loc", "_t", "_n", "_l1")
    ends = blocks.groupBy("_pid", *s).agg(F.max(F.struct("_loc", "_pid")).alias("_e")).select("_e._loc", "_e._pid", *s)
    last = inner.join(ends, ["_pid", "_loc", *s]).select("_pid", *s, "_t_after", "_n_after", "_l_after")
    outer = _carry(last, s, "_pid", "_t_after", "_n_after", "_l_after").select(
        F.col("_pid").alias("_pid"), *s, F.col("_n_before").alias("_n_in"), F.col("_l_before").alias("_l_in"))
    carry = inner.join(outer, ["_pid", *s]).select(
        *s, block_col,
        F.when(F.col("_t_before") > 0, F.col("_n_before")).otherwise(F.col("_n_in") + F.col("_n_before")).alias("_cpar"),
        F.coalesce("_l_before", "_l_in").alias("_cop"))

    # 3. state before each line -> record key
    x = x.join(carry, [*s, block_col], "left")
    first_seg = F.col("_seg") == 0
    parity = F.when(first_seg, F.col("_cpar") + F.col("_n1")).otherwise(F.col("_n1"))
    opener = F.when(first_seg, F.coalesce(F.col("_op"), F.col("_cop"))).otherwise(F.col("_op"))
    x = x.withColumn("_key", F.when(parity % 2 == 1, opener).otherwise(F.col("_pos")))
    return x


def repair_records(lines: DataFrame, stream_cols: Sequence[str], block_col: str, order_cols: Sequence[str],
                   line_col: str = "line", max_value: int = MAX_VALUE, folder: str | None = None) -> DataFrame:
    """All records and rejects: ``stream_cols..., start (position of the
    first line), n_lines, text, status ('ok' | 'reject'), reason, id, what,
    when, who``.  ``block_col`` orders blocks within a stream; ``order_cols``
    order lines within a block."""
    s = list(stream_cols)
    x = _keyed(lines, s, block_col, list(order_cols), line_col, folder)

    # 4. the record's lines of one block (a piece), then its pieces
    part = _pieces(x, s, block_col)
    tail = F.when(F.col("_pk") > 1, F.substring_index("_pt", ",", -2))
    part = part.withColumn("_id", F.substring_index("_pt", ",", 1)).withColumn("_tail", tail)
    part = part.withColumn("_whole", F.sum(F.octet_length("_pt").cast("long")).over(Window.partitionBy(*s, "_key")) <= max_value)
    rec = part.groupBy(*s, "_key").agg(
        F.array_sort(F.collect_list(F.when(F.col("_whole"), F.struct("_pb", "_pt")))).alias("_ls"),
        F.min(F.struct("_pb", "_id")).alias("_head"), F.max(F.struct("_pb", "_tail")).alias("_last"),
        F.sum("_pk").alias("_commas"), F.sum("_pn").alias("n_lines"), F.min("_whole").alias("_whole"))
    text = F.when(F.col("_whole"), F.array_join(F.transform(F.col("_ls"), lambda e: e["_pt"]), ""))
    rec = rec.select(*s, F.col("_key").alias("start"), "n_lines", text.alias("text"), "_commas",
                     F.col("_head._id").alias("_id"), F.col("_last._tail").alias("_tail"))
    ok = F.col("_commas") >= 3
    # between the id with its comma, and the last two fields with theirs
    what = F.expr("substring(text, length(_id) + 2, length(text) - length(_id) - length(_tail) - 2)")
    reason = (F.when(F.col("_commas") == 0, "no comma").when(F.col("_commas") == 1, "unfinished")
              .when(F.col("_commas") == 2, "two commas"))
    return rec.select(
        *s, "start", "n_lines", "text",
        F.when(ok, "ok").otherwise("reject").alias("status"),
        F.when(~ok, reason).alias("reason"),
        F.when(ok, F.col("_id")).alias("id"),
        F.when(ok, F.replace(what, F.lit(","), F.lit(";"))).alias("what"),
        F.when(ok, F.substring_index("_tail", ",", 1)).alias("when"),
        F.when(ok, F.substring_index("_tail", ",", -1)).alias("who"))


def _pieces(x: DataFrame, s: list[str], block_col: str) -> DataFrame:
    """The lines of each record in each block on end: (stream, _key, _pb, _pt, commas _pk, lines _pn)."""
    part = x.groupBy(*s, "_key", block_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_pos").alias("p"), F.col("_t").alias("t")))).alias("_ls"),
        F.sum("_k").alias("_pk"), F.count(F.lit(1)).alias("_pn"))
    return part.select(*s, "_key", "_pk", "_pn", F.col(block_col).alias("_pb"),
                       F.array_join(F.transform(F.col("_ls"), lambda e: e["t"]), "").alias("_pt"))


def record_pieces(lines: DataFrame, stream_cols: Sequence[str], block_col: str, order_cols: Sequence[str],
                  line_col: str = "line", folder: str | None = None) -> DataFrame:
    """The records of ``repair_records`` in pieces, one for each block that a record has lines in:
    (stream_cols..., start, piece (its block), text), in the order of piece; of any length."""
    s = list(stream_cols)
    part = _pieces(_keyed(lines, s, block_col, list(order_cols), line_col, folder), s, block_col)
    return part.select(*s, F.col("_key").alias("start"), F.col("_pb").alias("piece"), F.col("_pt").alias("text"))


def _carry(df: DataFrame, keys: Sequence[str], order: str, ended: str, count: str, opener: str) -> DataFrame:
    """State before and after each row of an ordered group: whether a closing line was
    seen, one-comma lines since the last one (or the group's start), newest opening line."""
    unb = Window.unboundedPreceding
    wo = Window.partitionBy(*keys).orderBy(order)
    x = df.withColumn("_t_after", F.sum(ended).over(wo.rowsBetween(unb, 0)))
    x = x.withColumn("_n_after", F.sum(count).over(Window.partitionBy(*keys, "_t_after").orderBy(order).rowsBetween(unb, 0)))
    x = x.withColumn("_l_after", F.max(opener).over(wo.rowsBetween(unb, 0)))
    return (x.withColumn("_t_before", F.coalesce(F.lag("_t_after", 1).over(wo), F.lit(0)))
            .withColumn("_n_before", F.coalesce(F.lag("_n_after", 1).over(wo), F.lit(0)))
            .withColumn("_l_before", F.lag("_l_after", 1).over(wo)))


def repair_files(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """D1 over text files: every file is its own stream.  A block is a run of at most
    ``BLOCK_LINES`` lines of a split, so that no window holds a whole split."""
    run = F.struct("block", F.floor(F.col("ln") / BLOCK_LINES).alias("run"))
    return repair_records(read_lines(spark, path).withColumn("block", run), ["file"], "block", ["ln"], folder=folder)


def records_as_csv(out: DataFrame) -> DataFrame:
    """The repaired lines ``id,what,when,who`` (header line included, as data)."""
    ok = out.filter(F.col("status") == "ok")
    return ok.select(F.concat_ws(",", "id", "what", "when", "who").alias("value"))


def unquote(col: Column) -> Column:
    """A CSV field as an import reads it: surrounding quotes go, doubled quotes become one."""
    quoted = F.length(col).__ge__(2) & col.startswith('"') & col.endswith('"')
    return F.when(quoted, F.replace(F.expr("substring(what, 2, length(what) - 2)"), F.lit('""'), F.lit('"'))).otherwise(col)


def repaired_history(out: DataFrame) -> DataFrame:
    """D1 -> IO1: repaired records as a typed log ``(id, what, ts, who)``, the text unquoted.
    The header line, which passes through the repair as a record, is no row."""
    ok = out.filter(F.col("status") == "ok")
    return ok.select(F.col("id").try_cast("bigint").alias("id"), F.coalesce(unquote(F.col("what")), F.lit("")).alias("what"),
                     F.col("when").try_cast("bigint").alias("ts"),
                     F.trim(F.col("who")).try_cast("bigint").alias("who")).filter(F.col("id").isNotNull())


def repaired_rejects(out: DataFrame) -> DataFrame:
    """What the repair or the typing turned away: (file, position, text, reason); the header is none."""
    header = (F.trim("id") == "id") & (F.col("status") == "ok")
    bad = F.col("id").try_cast("bigint").isNull() & (F.col("status") == "ok") & ~header
    return (out.withColumn("reason", F.when(bad, "id is not a number").otherwise(F.col("reason")))
            .filter((F.col("status") == "reject") | bad)
            .select("file", F.col("start.o0").alias("position"), "text", "reason"))


def load_repaired(spark: SparkSession, path: str, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Repair the text files under ``path``: the attribute log and the rejects."""
    out = repair_files(spark, path, folder)
    return repaired_history(out), repaired_rejects(out)


def document_lines(docs: DataFrame, block_docs: int = 64) -> DataFrame:
    """Broken CSV derived from ``documents``: one record ``doc_id,text,n_chars,source``
    per document, split at line breaks (``\\r\\n``, ``\\r``, ``\\n``) into lines;
    all documents form one stream in doc_id order."""
    rec = F.concat_ws(",", F.col("doc_id").cast("string"), F.col("text"), F.col("n_chars").cast("string"),
                      F.col("source"))
    x = docs.select("doc_id", F.posexplode(F.split(rec, "\\r\\n|\\r|\\n")).alias("ln", "line"))
    return x.select(F.lit(0).alias(STREAM), F.floor(F.col("doc_id") / block_docs).alias("block"),
                    "doc_id", "ln", "line")


def repair_documents(docs: DataFrame, block_docs: int = 64) -> DataFrame:
    """D1 over the documents stream; ``start_doc``/``start_ln`` locate each record's first line."""
    out = repair_records(document_lines(docs, block_docs), [STREAM], "block", ["doc_id", "ln"])
    return out.select(F.col("start.o0").alias("start_doc"), F.col("start.o1").alias("start_ln"),
                      "n_lines", "text", "status", "reason", "id", "what", "when", "who")
