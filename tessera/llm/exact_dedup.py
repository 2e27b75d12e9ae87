"""Exact de-duplication by progressive refinement, native.

Texts are compared with A-Z lower-cased (null counts as empty). Three levels,
each asking less rows for more:

1. rows are grouped by the length of the text in bytes;
2. those whose length occurs again, by length and a hash of the first ``HEAD``
   characters;
3. those whose length and head occur again, by the SHA-256 of the whole text.
   Only here is the content read in full, and only for them.

The keys of a level that occur more than once reach the rows as a bitmap of
``BITS`` bits: a table of at most ``BITS`` / 32768 rows of 4 KiB, whatever the
size of the corpus, so it is broadcast and no text is ever shuffled. A bit that
is set for another key lets a row through to the next level, never stops one,
and the last level compares whole hashes: the result is exact. Group sizes and
the surviving row are partial aggregates; the rows of a group meet them in a
join that adaptive execution splits when one group is very large.

Defined results: of equal texts the row with the largest id stays, a null id
counts as smallest, and of rows that repeat an id and its text one stays; null
and empty texts are one group; an empty table gives an empty result; all other
columns are carried in ``row`` under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import ascii_lower, scratch

HEAD = 64
BITS = 1 << 26


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)).cast("long")


def _repeated_bits(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bits): the bitmap of the values of ``key`` that occur more than once."""
    slots = rows.groupBy(key).count().where("count > 1").select(_slot(F.col(key), bits).alias("slot")).distinct()
    return scratch(
        slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
        ),
        "ed-bits",
    )


def _with_flag(rows: DataFrame, bitmap: DataFrame, key: str, flag: str, bits: int) -> DataFrame:
    """``flag``: whether the row's key may occur more than once."""
    slot = _slot(F.col(key), bits)
    position = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, position.bitwiseAND(F.lit(7)).cast("int"))
    # At most bits / 32768 rows of 4 KiB: a fixed bound.
    return rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(slot) == F.col("bucket"), "left").select(
        *rows.columns, (F.col("bits").isNotNull() & (F.coalesce(bit, F.lit(0)) == 1)).alias(flag)
    )


def mark_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    columns: tuple[str, ...] | None = None,
    hash_all: bool = False,
    head: int = HEAD,
    bits: int = BITS,
) -> DataFrame:
    """Every row of ``docs`` with keep_id, group_size, kept and sha256.

    ``row`` holds the columns named in ``columns`` (all of them by default).
    ``sha256`` is that of the normalised text, null where the content was not
    read in full; with ``hash_all`` it is given for every row.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in (columns or docs.columns)]).alias("row")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        carried,
        F.col(f"`{doc_id}`").alias("id"),
        body.alias("body"),
        F.octet_length(body).alias("size"),
        F.xxhash64(F.octet_length(body), ascii_lower(F.substring(body, 1, head))).alias("head"),
    )
    rows = _with_flag(rows, _repeated_bits(rows, "size", bits), "size", "same_size", bits)
    heads = _repeated_bits(rows.where("same_size"), "head", bits)
    rows = _with_flag(rows, heads, "head", "same_head", bits)
    again = F.col("same_size") & F.col("same_head")
    sha = F.sha2(ascii_lower(F.col("body")), 256)
    marked = scratch(
        rows.select(
            F.monotonically_increasing_id().alias("uid"), "id", again.alias("again"), "row",
            (sha if hash_all else F.when(again, sha)).alias("sha256"),
        ),
        "ed-marked",
    )
    read = marked.where("again")
    groups = read.groupBy(F.col("sha256").alias("key")).agg(
        F.max(F.struct(F.col("id"), (-F.col("uid")).alias("first"))).alias("top"), F.count(F.lit(1)).alias("group_size")
    )
    compared = read.join(groups, F.col("sha256") == F.col("key")).select(
        "row", F.col("top.id").alias("keep_id"), "group_size", (F.col("uid") == -F.col("top.first")).alias("kept"), "sha256"
    )
    alone = marked.where("NOT again").select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha256"
    )
    return compared.union(alone)


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, all columns untouched."""
    kept = mark_copies(docs, doc_id, text).where("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    marked = mark_copies(docs, columns=("doc_id",), hash_all=True)
    return marked.select(
        F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256")
    )


# DuckDB form of digest(documents).
DIGEST_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       (row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1) AS kept, sha256(t) AS text_sha256
FROM d
"""
