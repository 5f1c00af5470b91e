"""Operator 7: benchmark decontamination by size-partitioned MinHash containment search. [native]

Items are partitioned by size (powers of two of their distinct shingle count). In each
partition an item's sketch is its bottom-k MinHash: the k shingles of least hash, with k
one more than an item of the partition's largest size may miss at the threshold. A
document that contains enough of an item thus shares a hash of its sketch, whatever the
document's length: the search loses nothing. What it finds is verified by exact shingle
containment, |item and document| / |item|, on the shingles themselves.

Words are lower-cased (A-Z) runs of ASCII letters, digits and other characters from 0x80;
a shingle is five consecutive words. Items of one to four words are partitions of their
own: their one shingle is the whole sequence, sought among the documents' windows of that
many words. Items without words match nothing. Null texts are empty. Rows of null id are searched for nothing and left out of
the result; rows that share an id count as one document that holds the shingles of all.
Repeated items are items of their own; items that share an id count as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.llm.common import checkpointed, table
from petrel.llm.licenses import normalised

SHINGLE, CONTAINMENT = 5, 0.8
#: Rows up to which a table of hashes, shingles or ids is broadcast (some tens of megabytes); beyond, joins shuffle.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(normalised(text), " ", -1), lambda w: w != "")


def _starts(words: Column, n: int) -> Column:
    return F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column, n: int = SHINGLE) -> Column:
    return F.transform(_starts(words, n), lambda i: F.xxhash64(F.concat_ws(" ", *(F.get(words, i + k) for k in range(n)))))


def shingles(words: Column, n: int = SHINGLE) -> Column:
    return F.transform(_starts(words, n), lambda i: F.concat_ws(" ", F.slice(words, i + 1, n)))


def _by_length(words: Column, counts: list[int], of) -> Column:
    return F.concat(*(of(words, k) for k in counts)) if len(counts) > 1 else of(words, counts[0])


#: Bits of the filter for each sketch row, and longs of one of its chunks.
FILTER_BITS, CHUNK = 16, 4096


def _passing(hashes: DataFrame, sketch: DataFrame, rows: int) -> DataFrame:
    """The rows whose hash passes a bit filter of the sketches: about one in sixteen of those without a sketch.

    The filter is a broadcast table of chunks, of two bytes a sketch row; past 2**22 longs (32 MB) it stays at
    that size and passes more.
    """
    longs = min(1 << 22, max(CHUNK, 1 << (rows * FILTER_BITS // 64).bit_length()))
    spot = lambda h: F.pmod(h, F.lit(longs))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function("shiftrightunsigned", h, F.lit(58)).cast("int"))
    words = sketch.groupBy(spot(F.col("hash")).alias("spot")).agg(F.bit_or(bit(F.col("hash"))).alias("bits"))
    chunk = F.floor(F.col("spot") / CHUNK).cast("int")
    packed = words.groupBy(chunk.alias("chunk")).agg(F.map_from_entries(F.collect_list(F.struct(F.pmod("spot", F.lit(CHUNK)).cast("int"), "bits"))).alias("found"))
    dense = packed.select("chunk", F.transform(F.sequence(F.lit(0), F.lit(CHUNK - 1)), lambda i: F.coalesce(F.element_at("found", i), F.lit(0).cast("long"))).alias("bits"))
    spotted = hashes.withColumn("spot", spot(F.col("hash"))).withColumn("chunk", chunk)
    return spotted.join(F.broadcast(dense), "chunk").where(F.get("bits", F.pmod("spot", F.lit(CHUNK)).cast("int")).bitwiseAND(bit(F.col("hash"))) != 0).select(*hashes.columns)


def _hint(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def sketches(items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(item_id, n_item, hash): the bottom-k sketch of each item of (item_id, hash, shingle), k by size partition."""
    from pyspark.sql import Window as W

    by_item = W.partitionBy("item_id")
    sized = items.select("item_id", "hash").distinct().withColumns({"n_item": F.count(F.lit(1)).over(by_item), "place": F.row_number().over(by_item.orderBy("hash"))})
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n_item"))) + 1) - 1
    # the nudges keep a product that should be whole from rounding up, and one item more costs nothing
    k = largest - F.ceil(F.lit(containment) * largest - 1e-6) + 1
    return sized.where(F.col("place") <= k).select("item_id", "hash")


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = SHINGLE, containment: float = CONTAINMENT, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(id, item_id, n_shared, n_item, containment) of every document and item in it."""
    item_words = items.where(items[item_id].isNotNull()).select(items[item_id].alias("item_id"), words_of(items[item_text].cast("string")).alias("w"))
    # at most n lengths, whatever the items
    lengths = sorted({n, *(r[0] for r in item_words.where((F.size("w") > 0) & (F.size("w") < n)).select(F.size("w")).distinct().collect())})
    own = F.when(F.size("w") >= n, shingles(F.col("w"), n)).when(F.size("w") > 0, F.array(F.array_join("w", " "))).otherwise(F.array().cast("array<string>"))
    item_shingles = checkpointed(item_words.select("item_id", F.explode(own).alias("shingle")).distinct().withColumn("hash", F.xxhash64("shingle")))
    n_shingles = item_shingles.count()
    sketch = checkpointed(sketches(item_shingles, containment))
    text = docs.where(docs[id_col].isNotNull()).select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    # the words are a column of their own: inside a lambda an expression is evaluated for every element
    hashes = text.select("id", words_of(F.col("text")).alias("w")).select("id", F.explode(_by_length(F.col("w"), lengths, shingle_hashes)).alias("hash"))
    n_sketch = sketch.count()
    if n_sketch > broadcast_rows:
        hashes = _passing(hashes, sketch, n_sketch)
    candidates = checkpointed(hashes.join(_hint(sketch, n_sketch, broadcast_rows), "hash").select("id", "item_id").distinct())
    found = candidates.select("id").distinct()
    rows = text.join(_hint(found, candidates.count(), broadcast_rows), "id", "left_semi")
    held = rows.select("id", words_of(F.col("text")).alias("w")).select("id", F.explode(F.array_distinct(_by_length(F.col("w"), lengths, shingles))).alias("shingle"))
    shared = held.join(_hint(item_shingles.select("shingle", "item_id"), n_shingles, broadcast_rows), "shingle").distinct().groupBy("id", "item_id").agg(F.count(F.lit(1)).alias("n_shared"))
    sizes = item_shingles.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    verified = candidates.join(shared, ["id", "item_id"]).join(sizes, "item_id")
    # whole numbers decide: shared / n >= containment, as hundredths of a thousandth
    enough = F.col("n_shared") * 100_000 >= F.col("n_item") * round(containment * 100_000)
    return verified.where(enough).select(F.col("id").alias(id_col), "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '')"

ORACLE = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM dw WHERE len(w) >= 5),
short AS (SELECT item_id, array_to_string(w, ' ') AS s, len(w) AS k FROM iw WHERE len(w) BETWEEN 1 AND 4),
dss AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM dw, (SELECT DISTINCT k FROM short) WHERE len(w) >= k),
its AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM iw WHERE len(w) >= 5 UNION SELECT item_id, s FROM short),
n AS (SELECT item_id, count(*) AS n_item FROM its GROUP BY item_id),
x AS (SELECT doc_id, item_id, count(*) AS n_shared FROM (SELECT * FROM ds UNION SELECT * FROM dss) JOIN its USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM x JOIN n USING (item_id) WHERE n_shared * 100000 >= n_item * 80000
"""
