"""Benchmark decontamination: short test items inside long documents.

Items are partitioned by size, in powers of two of their distinct word shingles. All
items of a partition are indexed by the same number of MinHash values, their smallest
shingle hashes: one more than the largest item of the partition may miss, so a document
that contains the wanted share of an item holds at least one of them. Documents are
probed with their whole texts; of their shingles only those below the largest indexed
hash take part. What remains is verified by counting the item's shingles, as text, in the
candidate documents.

Only DataFrame functions are used. Documents are neither joined with each other nor
shuffled: what is shuffled are hits.

Defined results: words are runs of letters and digits in lower case; a null text counts as
empty; an item with fewer words than a shingle has all its words as its one shingle, which
documents are probed for at its own width, wherever it stands in them; items without words
are found nowhere; items that repeat in id and text count as one, texts that
share an id or have none are judged and reported each; rows with the same doc_id count as
one document, their shingles together, and rows without one are in no pair (dropping judges
them each); an empty table on either side gives an empty result; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import broadcast_if_small, fresh_name, row_key, written

WIDTH = 5
SHARE = 0.8
#: Rows of two longs up to this count are sent to all executors: indexed or wanted hashes.
BROADCAST_ROWS = 200_000


def _words(text: Column) -> Column:
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(split, "")


def _at(width: int, form: str) -> str:
    """SQL for the shingles of ``width`` words of the column ``words``, which has so many."""
    each = ", ".join(f"words[i + {k}]" for k in range(width))
    # Longer shingles' hashes are seeded by the one before, shorter ones' are of their text.
    one = f"xxhash64({each})" if form == "hash" and width == WIDTH else f"concat_ws(' ', {each})"
    one = f"xxhash64({one})" if form == "hash" and width < WIDTH else one
    return f"transform(sequence(0, size(words) - {width}), i -> {one})"


def _own(form: str) -> Column:
    """The shingles of an item: of five words, or of all its words if it has fewer."""
    cases = " ".join(f"WHEN size(words) = {w} THEN {_at(w, form)}" for w in range(1, WIDTH))
    return F.expr(f"CASE WHEN size(words) >= {WIDTH} THEN {_at(WIDTH, form)} {cases} END")


def _probes(form: str, widths: list[int]) -> Column:
    """The shingles of a document at the widths that items have."""
    parts = [f"if(size(words) >= {w}, {_at(w, form)}, array())" for w in widths]
    return F.expr(f"concat({', '.join(parts)})") if parts else F.expr("array()")


def _index(items: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """(no, item, n, shingle) for all shingles; (no, width, h) for the indexed MinHash values.

    ``no`` numbers the distinct rows of ``items``, whose ids may be null or repeat.
    """
    rows = items.distinct().select("item", _words(F.col("t")).alias("words"))
    rows = rows.where("size(words) > 0").select(
        "item",
        F.array_distinct(_own("text")).alias("s"),
        F.array_distinct(_own("hash")).alias("h"),
        F.least(F.size("words"), F.lit(WIDTH)).alias("width"),
    )
    rows = rows.withColumn("n", F.size("s"))
    # Written at once: the numbers stay the same from then on.
    rows = written(rows.withColumn("no", F.monotonically_increasing_id()), "items")
    # Partition c holds items of 2 ** c up to 2 ** (c + 1) - 1 shingles.
    most = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1
    keep = (F.floor((1 - share) * most + 1e-9) + 1).cast("int")
    smallest = F.slice(F.array_sort("h"), 1, F.least(keep, F.size("h")))
    hashes = rows.select("no", "width", F.explode(smallest).alias("h"))
    return rows.select("no", "item", "n", F.explode("s").alias("shingle")), hashes


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    share: float = SHARE,
) -> DataFrame:
    """(doc_id, item_id, shared, shingles): documents with at least ``share`` of an item.

    ``shared`` counts distinct shingles of the item that the document holds, ``shingles``
    all of the item's. Both tables have their text in the column ``text``.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col("text").alias("t"))
    items = items.select(F.col(f"`{item_col}`").alias("item"), F.col("text").alias("t"))
    texts, hashes = _index(items, share)
    hashes = written(hashes, "minhash")
    count, top, widths = hashes.agg(F.count("*"), F.max("h"), F.sort_array(F.collect_set("width"))).first()

    rows = docs.select("doc", _words(F.col("t")).alias("words"))
    hits = rows.select("doc", F.explode(_probes("hash", widths).cast("array<long>")).alias("h"))
    hits = hits.where(F.col("h") <= F.lit(top if count else 0))
    hits = hits.join(broadcast_if_small(hashes.select("no", "h"), count, BROADCAST_ROWS), "h")
    candidates = written(hits.select("doc", "no").distinct(), "candidates")

    texts = written(texts.join(candidates.select("no").distinct(), "no", "left_semi"), "wanted")
    code = F.xxhash64("shingle").alias("code")
    wanted = written(texts.select(code).distinct(), "codes")
    held = rows.join(candidates.select("doc").distinct(), "doc", "left_semi")
    held = held.select("doc", F.explode(_probes("text", widths).cast("array<string>")).alias("shingle"))
    held = held.withColumn("code", code)
    # The hash only lets fewer through; what counts is the shingle's text.
    held = held.join(broadcast_if_small(wanted, wanted.count(), BROADCAST_ROWS), "code", "left_semi")
    held = written(held.select("doc", "shingle").distinct(), "held")
    found = candidates.join(texts, "no").join(held, ["doc", "shingle"])
    found = found.groupBy("doc", "no", "item", "n").agg(F.count("*").alias("shared"))
    found = found.where(F.col("shared") >= F.ceil(share * F.col("n") - 1e-9))
    return found.select(
        F.col("doc").alias(id_col),
        F.col("item").alias(item_col),
        "shared",
        F.col("n").cast("long").alias("shingles"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` without those that hold an item; rows without an id are judged each."""
    name = fresh_name(docs, "key")
    keyed = docs.withColumn(name, row_key(docs))
    found = written(contaminated(keyed, items, name, share=share).select(name).distinct(), "leaks")
    return keyed.join(found, name, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def oracle(share: float = SHARE) -> str:
    """The same by DuckDB, comparing every item's shingles with every document's."""

    def words(table: str, keys: str) -> str:
        return f"""SELECT {keys}, list_filter(string_split_regex(lower(coalesce(text, '')),
                    '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table}"""

    shingles = """unnest(list_transform(range(1, len(w) - k + 2),
                    lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s"""
    return f"""WITH dw AS ({words("documents", "doc_id")}),
        b AS MATERIALIZED (SELECT row_number() OVER () AS no, * FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        bw AS (SELECT *, least(len(w), {WIDTH}) AS k FROM ({words("b", "no, item_id")}) WHERE len(w) > 0),
        d AS (SELECT DISTINCT doc_id, {shingles} FROM dw, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k),
        i AS (SELECT DISTINCT no, item_id, {shingles} FROM bw),
        n AS (SELECT no, count(*) AS shingles FROM i GROUP BY no)
        SELECT doc_id, item_id, count(*) AS shared, any_value(shingles) AS shingles
        FROM d JOIN i USING (s) JOIN n USING (no) GROUP BY doc_id, no, item_id
        HAVING count(*) >= ceil({share} * any_value(shingles) - 1e-9)"""
