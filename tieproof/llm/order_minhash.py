"""Document fingerprints by order MinHash: tuples of the smallest k-mers of each bin, in the order of the text.

A text is cut into tokens of up to four characters (from the start of each word);
a k-mer is a run of three tokens. The first, second, ... occurrence of a k-mer are
numbered, so repeats count. Hashes of numbered k-mers fall into bins; of each bin
the smallest ``tuple_size`` are taken, put back into the order in which they stand
in the text, and hashed together: moving parts of a text changes tuples although
it changes few k-mers. One permutation cut into bins stands for as many
permutations, so a text is sorted twice, whatever the number of bins.

Built-in functions only. Inside a row everything is an array of longs: a hash in
the upper half, a position in the lower one, which sorts without objects.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.llm.tables import partitions, query, table

TOKEN = r"[^\s]{1,4}"
K, BIN_BITS, TUPLE = 3, 6, 2
SIG_BITS = 24
_UPPER, _LOWER = -1 << 32, (1 << 32) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _upto(n: Column) -> Column:
    """0 to n - 1, nothing for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _upper(v: Column) -> Column:
    return F.shiftright(v, 32)


def _packed(hash_: Column, position: Column) -> Column:
    return hash_.bitwiseAND(F.lit(_UPPER)).bitwiseOR(position.cast("long"))


def kmers(text: Column, k: int = K, token: str = TOKEN) -> Column:
    """Sorted (hash, position) of the k-mers of a text; fewer tokens than ``k`` are one k-mer, a text without any has none."""

    def of(t: Column) -> Column:
        n = F.size(t)
        runs = F.transform(_upto(n - (k - 1)), lambda i: _packed(F.xxhash64(*[F.get(t, i + j) for j in range(k)]), i))
        few = F.array(_packed(F.xxhash64(t), F.lit(0)))
        return F.sort_array(F.when(n >= k, runs).when(n > 0, few).otherwise(F.array().cast("array<bigint>")))

    return _let(F.regexp_extract_all(text, F.lit(token), F.lit(0)), of)


def numbered(sorted_kmers: Column) -> Column:
    """The same with hashes of (k-mer, how often it stood before)."""

    def of(s: Column) -> Column:
        def runs(first: Column) -> Column:
            def run(start: Column, r: Column) -> Column:
                end = F.coalesce(F.get(first, r + 1), F.size(s))
                return F.transform(F.slice(s, start + 1, end - start),
                                   lambda v, o: _packed(F.xxhash64(_upper(v), o), v.bitwiseAND(F.lit(_LOWER))))
            return F.flatten(F.transform(first, run))
        starts = F.filter(_upto(F.size(s)), lambda i: (i == 0) | (_upper(F.get(s, i)) != _upper(F.get(s, i - 1))))
        return _let(starts, runs)

    return _let(sorted_kmers, of)


def fingerprint(text: Column, k: int = K, token: str = TOKEN, bin_bits: int = BIN_BITS, tuple_size: int = TUPLE) -> Column:
    """array<int>, sorted: bin and 24 bits of its tuple, for each bin that holds a k-mer. Empty for a text without tokens."""
    bin_of = lambda v: F.shiftright(v, 64 - bin_bits)

    def of(t: Column) -> Column:
        def entry(i: Column) -> Column:
            own = bin_of(F.get(t, i))
            least = F.filter(F.slice(t, i + 1, tuple_size), lambda v: bin_of(v) == own)
            # position first: the order of the text
            ordered = F.sort_array(F.transform(least, lambda v: F.shiftleft(v, 32).bitwiseOR(F.shiftrightunsigned(v, 32))))
            sig = F.xxhash64(F.transform(ordered, lambda v: v.bitwiseAND(F.lit(_LOWER))))
            place = own + (1 << (bin_bits - 1))
            return F.shiftleft(place, SIG_BITS).bitwiseOR(sig.bitwiseAND(F.lit((1 << SIG_BITS) - 1))).cast("int")
        starts = F.filter(_upto(F.size(t)), lambda i: (i == 0) | (bin_of(F.get(t, i)) != bin_of(F.get(t, i - 1))))
        return F.transform(starts, entry)

    return _let(F.sort_array(numbered(kmers(text, k, token))), of)


def likeness(a: Column, b: Column, tuple_size: int = TUPLE) -> Column:
    """0 to 1: estimated share of numbered k-mers in common and in order, of the fingerprints of two texts.

    A tuple agrees if all its k-mers do, so the share of agreeing tuples is about
    the ``tuple_size``-th power of the Jaccard index; that is turned into 2 J / (1 + J),
    which for a text with a part replaced is the part that stayed. Two texts
    without tokens are alike (1).
    """
    bins = F.size(F.array_union(*[F.transform(x, lambda e: F.shiftright(e, SIG_BITS)) for x in (a, b)]))
    share = F.size(F.array_intersect(a, b)) / F.greatest(bins, F.lit(1))
    return F.when(bins == 0, F.lit(1.0)).otherwise(_let(F.pow(share, F.lit(1.0 / tuple_size)), lambda j: 2 * j / (1 + j)))


def as_text(entries: Column) -> Column:
    """A fingerprint as hex digits, eight for each bin."""
    return F.array_join(F.transform(entries, lambda e: F.lpad(F.lower(F.hex(e)), 8, "0")), "")


def with_next(rows: DataFrame, key: str, text: str, values: dict[str, str], block: int = 64) -> DataFrame:
    """Each row with what the next row in the order of ``key`` holds (``values``: new column to column); the last
    row gets the first one's.

    Null keys come first; rows with one key are ordered by ``text``. No task sees
    more than a range of the order: its bounds are keys that exist, a few for each
    shuffle partition, and the rows at a bound go to the range before as well.
    """
    spark = rows.sparkSession
    n = 4 * partitions(spark)
    keyed = rows.withColumn("_tie", F.xxhash64(text))
    at = F.struct(F.col(key).alias("k"), F.col("_tie").alias("t"))
    light = keyed.select(key, "_tie").repartitionByRange(n, F.col(key).asc_nulls_first(), "_tie")
    least = light.withColumn("_p", F.spark_partition_id()).groupBy("_p").agg(F.min(at).alias("b")).select(F.col("b.k"), F.col("b.t"))
    bounds = [r[0] for r in least.orderBy(F.col("k").asc_nulls_first(), "t").select(F.to_json(F.struct("k", "t"))).collect()]
    kind = f"struct<k:{rows.schema[key].dataType.simpleString()},t:bigint>"
    listed = lambda some: F.from_json(F.lit("[" + ",".join(some) + "]"), f"array<{kind}>")
    if not bounds:
        return rows.limit(0).select("*", *[F.col(v).alias(k) for k, v in values.items()])
    fits = lambda some: F.size(F.filter(some, lambda b: b <= F.col("_at")))
    keyed = keyed.withColumn("_at", at)
    if len(bounds) > block:
        keyed = keyed.withColumn("_base", (F.greatest(fits(listed(bounds[::block])), F.lit(1)) - 1) * block)
    else:
        keyed = keyed.withColumn("_base", F.lit(0))
    own = F.col("_base") + F.greatest(fits(F.slice(listed(bounds), F.col("_base") + 1, F.lit(block))), F.lit(1)) - 1
    keyed = keyed.withColumn("_own", own)
    first = F.get(listed(bounds), F.col("_own")) == F.col("_at")
    place = lambda p, extra: F.struct(p.cast("int").alias("p"), F.lit(extra).alias("extra"))
    before = F.pmod(F.col("_own") - 1, F.lit(len(bounds)))
    places = F.when(first, F.array(place(F.col("_own"), False), place(before, True))).otherwise(F.array(place(F.col("_own"), False)))
    dealt = keyed.withColumn("_to", F.explode(places)).select(*rows.columns, "_tie", "_to.p", "_to.extra")
    order = Window.partitionBy("p").orderBy("extra", F.col(key).asc_nulls_first(), "_tie", text)
    out = dealt.withColumns({k: F.lead(v).over(order) for k, v in values.items()})
    return out.where(~F.col("extra")).drop("_tie", "p", "extra")


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    The edited text of a document has its last quarter of code points replaced by
    as many of the first ones of the next document (fewer, if that is shorter).
    Null texts are empty. Null ids come first; rows with one id are ordered by a
    hash of their text and its bytes, rows equal in both are next to each other.
    With one document only it is its own next one.
    """
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs.withColumn("entries", fingerprint(F.col("text"))), "doc_id", "text",
                     {"next_text": "text", "next_entries": "entries"})
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "entries", "next_entries", edited.alias("edited"))
    made = F.struct(F.sha2("edited", 256).alias("sha"), fingerprint(F.col("edited")).alias("entries"))
    rows = rows.withColumn("made", _let(made, lambda x: x))
    return rows.select(
        "doc_id", "n_chars", F.col("made.sha").alias("edited_sha256"), as_text(F.col("entries")).alias("fingerprint"),
        as_text(F.col("made.entries")).alias("edited_fingerprint"), likeness(F.col("entries"), F.col("made.entries")).alias("near_edited"),
        likeness(F.col("entries"), F.col("next_entries")).alias("near_next"))


@query("op13_order_minhash")
def op13_order_minhash(spark, folder):
    return edited_fingerprints(table(spark, folder, "documents", "doc_id", "text"))
