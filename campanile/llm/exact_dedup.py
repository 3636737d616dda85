"""Exact dedup by two-pass Bloom filtering, with DataFrame functions only.

Pass 1 turns every text into a digest and counts, per filter bit, how many rows hit it; bits that were
hit twice or more make up the filter of possibly repeated digests. Pass 2 probes that filter: rows with a
bit that was hit once are unique for certain and pass straight through without a shuffle; only the others
are grouped by their digest.

The filter has ``bits_per_row`` bits a row, rounded up to a power of two, and at most ``max_bits``: that
bounds what is broadcast to 16 bytes for each 64 bits (64 MB at the default). Beyond ``max_bits / bits_per_row``
rows false positives get more frequent, so more rows are grouped; the answer stays exact.

Defined cases: a null text counts as empty. Texts are equal when they are identical after deleting
``[\\x20\\x09-\\x0D]``; all empty ones are equal. Of equal texts stays the row with the most code points, then
the smallest id (a null id is smaller than any). Rows that repeat both id and text are one document: all of
them are annotated alike, ``drop_repeats`` keeps one of them. Texts of any length are digested whole. Other columns, whatever
their names, are passed on untouched by ``drop_repeats`` and not looked at by ``annotate``. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campanile.llm.common import ASCII_SPACE, written

BITS_PER_ROW = 16
MAX_BITS = 1 << 28


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), ASCII_SPACE, F.coalesce(text, F.lit("")))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(id, chars, sha, more columns): sha is the SHA-256 of the normalised text as 64 hex digits."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("chars"),
        F.sha2(normalised(text), 256).alias("sha"),
        *more,
    )


def filter_words(rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> int:
    """Number of 64-bit words of the filter for so many rows: a power of two."""
    bits = 1 << max(16, (max(1, rows) * bits_per_row - 1).bit_length())
    return min(bits, max_bits) >> 6


def place(h: Column, words: int) -> tuple[Column, Column, Column]:
    """The word of a hash in the filter and its two bits there."""
    word = F.pmod(h, F.lit(words))
    return word, F.shiftrightunsigned(h, 52).bitwiseAND(F.lit(63)), F.shiftrightunsigned(h, 58)


def repeat_filter(digested: DataFrame, words: int) -> DataFrame:
    """(word, bits): the filter's bits that two rows or more have hit."""
    word, a, b = place(F.xxhash64("sha"), words)
    hits = digested.select(F.explode(F.array_distinct(F.array(word * 64 + a, word * 64 + b))).alias("bit")).groupBy("bit").count()
    return (
        hits.where(F.col("count") > 1)
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    )


def probe(rows: DataFrame, bloom: DataFrame, words: int, h: Column | None = None) -> DataFrame:
    """Adds ``maybe``: whether both bits of a hash (default: the digest's) are in the filter."""
    word, a, b = place(F.xxhash64("sha") if h is None else h, words)
    held = rows.withColumns({"word": word, "a": a.cast("int"), "b": b.cast("int")})
    held = held.join(F.broadcast(bloom), "word", "left")
    both = F.expr("coalesce((bits >> a) & (bits >> b) & 1L, 0L) = 1L")
    return held.withColumn("maybe", both).drop("word", "a", "b", "bits")


def groups_of(repeated: DataFrame) -> DataFrame:
    """(sha, keep_id, keep_chars, size) of the digests among possibly repeated rows."""
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("id").alias("id")))
    return repeated.groupBy("sha").agg(best.alias("best"), F.count(F.lit(1)).alias("size")).select(
        "sha", F.col("best.id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"), "size"
    )


def annotate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS
) -> DataFrame:
    """A row for each row of docs: id, keep_id, group_size, kept, text_sha256."""
    digested = written(digests(docs, id_col, text_col), "digests")
    words = filter_words(digested.count(), bits_per_row, max_bits)
    bloom = written(repeat_filter(digested, words), "bloom")
    probed = probe(digested, bloom, words)
    single = probed.where("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256")
    )
    repeated = probed.where("maybe").drop("maybe")
    # the groups are dealt out anew so that both sides of the join are shuffled for it, and Spark can split a hot digest
    groups = groups_of(repeated).hint("rebalance")
    joined = repeated.join(groups, "sha").select(
        "id",
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return single.unionByName(joined)


def _key(id_: Column, raw: Column) -> Column:
    return F.xxhash64(id_, raw)


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS
) -> DataFrame:
    """docs without the rows whose text another row repeats; same columns. Unique rows never shuffle.

    Texts are normalised and digested once, in the first pass. The second knows a row by its id and a quick hash of its text as it is;
    a filter of the rows that are in groups of two or more lets all others pass straight through.
    """
    columns = docs.columns
    raw = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    digested = written(digests(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), raw.alias("raw")), "id", "text", "raw"), "digests")
    words = filter_words(digested.count(), bits_per_row, max_bits)
    maybe = probe(digested, written(repeat_filter(digested, words), "bloom"), words).where("maybe")
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("id").alias("id"), F.col("raw").alias("raw"))).alias("best")
    groups = maybe.groupBy("sha").agg(best, F.count(F.lit(1)).alias("size")).where("size > 1").hint("rebalance")
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("raw") == F.col("best.raw"))
    # a row for each id and text in a group; at most one of a group stays
    members = written(maybe.join(groups, "sha").groupBy("id", "raw").agg(F.bool_or(stays).alias("stays")), "members")
    words = filter_words(members.count(), bits_per_row, max_bits)
    bits = F.array(*[x.cast("int") for x in place(_key(F.col("id"), F.col("raw")), words)[1:]])
    known = members.select(place(_key(F.col("id"), F.col("raw")), words)[0].alias("word"), F.explode(bits).alias("bit"))
    known = written(known.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")), "bloom")
    whole = docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"))
    text = F.coalesce(F.col(f"row.{text_col}").cast("string"), F.lit(""))
    whole = whole.select("row", F.col(f"row.{id_col}").alias("of_id"), F.xxhash64(text).alias("of_raw"))
    whole = probe(whole, known, words, _key(F.col("of_id"), F.col("of_raw")))
    seen = whole.where("maybe").join(members, F.col("of_id").eqNullSafe(F.col("id")) & (F.col("of_raw") == F.col("raw")), "left")
    first = seen.where("stays").dropDuplicates(["of_id", "of_raw"])
    return whole.where("not maybe").select("row").unionByName(seen.where("stays is null").select("row")).unionByName(first.select("row")).select("row.*")
