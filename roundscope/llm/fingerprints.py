"""Document fingerprints by one-permutation MinHash, in DataFrame operations only.

Each five-word shingle is hashed once; the upper bits of the hash name its bin, and every bin keeps its least hash.
An empty bin takes the value of a filled one: the first filled bin in an order of all bins that is random, and fixed
for that empty bin (optimal densification), so equal sets choose alike and every filled bin is as likely. Of each bin
the low-order bits are kept and packed. Bits of different values agree by chance once in 2^bits; the likeness takes
that out of the share of agreeing bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundscope.llm.common import checkpointed, text_rows
from roundscope.llm.quality import words

SHINGLE_WORDS = 5
#: 2^BIN_BITS bins of which KEPT_BITS low-order bits are stored.
BIN_BITS = 7
KEPT_BITS = 8
BINS = 1 << BIN_BITS


def shingle_hashes(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """Sorted hashes of the shingles; a text of fewer words is one shingle, one without words has none."""
    tokens = words(text)
    return F.transform(F.array(tokens), lambda w: _hashes(w, size))[0]


def _hashes(w: Column, size: int) -> Column:
    n = F.size(w)
    many = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    few = F.array(F.xxhash64(F.array_join(w, " ")))
    return F.sort_array(F.when(n >= size, many).when(n > 0, few).otherwise(F.array().cast("array<bigint>")))


def bin_of(h: Column) -> Column:
    """The bin of a hash; greater hashes never have smaller bins."""
    return (F.shiftright(h, 64 - BIN_BITS) + BINS // 2).cast("int")


def fingerprint(hashes: Column) -> Column:
    """Packed low-order bits of all bins, from the sorted hashes; empty bytes for a text without words."""
    least = F.filter(hashes, lambda h, j: (j == 0) | (bin_of(h) != bin_of(F.get(hashes, j - 1))))
    return F.transform(F.array(least), _packed)[0]


def _packed(least: Column) -> Column:
    """``least`` has the least hash of every filled bin, in the order of the bins."""
    filled = F.transform(least, bin_of)

    def pack(pair: Column) -> Column:
        bins, values = pair["bins"], pair["values"]

        def lane(b: Column) -> Column:
            at = F.array_position(bins, b)
            giver = F.array_min(F.transform(bins, lambda j: F.struct(F.xxhash64(b, j).alias("p"), j.alias("j"))))["j"]
            value = F.get(values, F.when(at > 0, at).otherwise(F.array_position(bins, giver)).cast("int") - 1)
            return F.lpad(F.hex(value.bitwiseAND(F.lit((1 << KEPT_BITS) - 1))), 2, "0")

        return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lane), ""))

    pairs = F.array(F.struct(filled.alias("bins"), least.alias("values")))
    return F.when(F.size(least) == 0, F.unhex(F.lit(""))).otherwise(F.transform(pairs, pack)[0])


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1; two texts without words are alike, one of them is like no other."""
    lanes = F.sequence(F.lit(1), F.lit(BINS))
    agree = F.size(F.filter(lanes, lambda i: F.substring(a, i, 1) == F.substring(b, i, 1))) / BINS
    chance = 2.0**-KEPT_BITS
    return (
        F.when((F.length(a) == 0) & (F.length(b) == 0), 1.0)
        .when((F.length(a) == 0) | (F.length(b) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), (agree - chance) / (1 - chance)))
    )


def shown(packed: Column) -> Column:
    return F.lower(F.hex(packed))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, text_hash, packed binary): one row per row of ``docs``; a null text counts as empty.

    Repeated rows stay and other columns are not read. An empty table gives no rows.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("hashes", shingle_hashes(F.col("text")))
    return rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), fingerprint(F.col("hashes")).alias("packed"))


def successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_chars, next_id, next_hash): the next document by descending id, after the last the first.

    Rows alike in id and text are one document. Documents that share an id follow each other by a hash of their text;
    those without an id come last. Only ids are sorted: by ranges, in which places are counted from where each range
    begins.
    """
    rows = text_rows(docs, id_col, text_col)
    ids = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.length("text").cast("long").alias("n_chars")).distinct()
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash")]
    ids = checkpointed(ids.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ids = ids.select("doc_id", "text_hash", "n_chars", part.alias("part"), place.alias("place"))
    sizes = ids.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row per range of the sort: few, whatever the number of documents.
    begins = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("begin"))
    total = F.lit(ids.count())
    ranked = ids.join(F.broadcast(begins), "part").withColumn("rank", F.col("begin") + F.col("place"))
    follow = ranked.select(F.col("rank").alias("next_rank"), F.col("doc_id").alias("next_id"), F.col("text_hash").alias("next_hash"))
    ranked = ranked.withColumn("next_rank", (F.col("rank") + 1) % total)
    return ranked.join(follow, "next_rank").select("doc_id", "text_hash", "n_chars", "next_id", "next_hash")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its edited text, whose last half is replaced by the beginning of the next document.

    Columns: doc_id, n_chars, packed, edited_text, edited_packed, next_packed; the packed ones are fingerprints.
    A document alone is its own next one.
    """
    own = fingerprints(docs, id_col, text_col)
    follow = successors(docs, id_col, text_col)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    key = F.col("doc_id").eqNullSafe(F.col("next_id")) & (F.col("own_hash") == F.col("next_hash"))
    nexts = own.withColumnRenamed("text_hash", "own_hash").join(
        follow.select(F.col("doc_id").alias("owner"), F.col("text_hash").alias("owner_hash"), "n_chars", "next_id", "next_hash"), key
    )
    nexts = nexts.select("owner", "owner_hash", "n_chars", F.substr("text", F.lit(1), half).alias("start"), F.col("packed").alias("next_packed"))
    nexts = nexts.dropDuplicates(["owner", "owner_hash"])
    rows = own.join(nexts, F.col("doc_id").eqNullSafe(F.col("owner")) & (F.col("text_hash") == F.col("owner_hash")))
    kept = F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half)
    rows = rows.select("doc_id", "n_chars", "packed", "next_packed", F.concat(kept, F.col("start")).alias("edited_text"))
    rows = rows.withColumn("hashes", shingle_hashes(F.col("edited_text")))
    return rows.select("doc_id", "n_chars", "packed", "next_packed", "edited_text", fingerprint(F.col("hashes")).alias("edited_packed"))
