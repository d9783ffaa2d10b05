"""Near copies: documents whose sets of word shingles overlap by a share of their union.

1. Documents with the same set are one class from here on.
2. Prefix filter, exact: ordered by one rule for all documents, two sets that
   overlap enough share one of the first elements of each. Elements that a
   sample shows to be frequent come last in that order, so passages that many
   documents hold do not bring those together. (The sample decides the order
   alone; any order finds the same links.)
3. Classes that share such an element are a group. Those that share many of them
   with the first of the group are candidates at once; in groups that this leaves
   in several parts, signature trees over bitmaps of the sets leave the pairs
   that may overlap enough.
4. What these candidates connect is a unit. Its whole sets are read once more,
   and signature trees with an exact test on top give the links.
5. Components of the links.

Groups and units larger than a block are cut: blocks are walked by themselves,
then every item is compared with a few hubs of its group, and only items that are
not in the group's largest component by then are compared with all others, block
by block. So a group of copies of any size costs about its own size, and every
link that connects anything is kept.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.llm.components import components
from tieproof.llm.signature_tree import Links, Tree, bitmap, bits_for, folded, shared_elements
from tieproof.llm.tables import query, saved, table
from tieproof.llm.words import chunks, shingles, split

#: Items that one task walks together.
BLOCK = 256
HUBS = 4


def _row() -> Column:
    """Tells apart the rows of one id."""
    return F.xxhash64("text").alias("row")


def _first_row() -> Column:
    """The row with the smallest id, null ids last, ties by the hash of the text."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row"] == b["row"])


def _class_of(s: np.ndarray) -> int:
    """64 bits for the whole set; differing sets of a corpus of n share them with chance n * n / 2 ** 65."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def frequent_shingles(documents: DataFrame, size: int, one_in: int = 16, least: int = 4, most: int = 65_536,
                      lowest: float = 0.3) -> np.ndarray:
    """Hashes of shingles that ``least`` documents of a sample hold, the commonest ``most`` of them, sorted.

    The sample is the documents whose hashed id is divisible by ``one_in``. Only the ``lowest`` share of
    hashes is counted: what is above hardly gets among the first elements of a set.
    """
    sample = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0).select("text")
    limit = np.uint64(int(lowest * (1 << 64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(0)):
                found = [s[:np.searchsorted(s, limit)] for s in shingles(split(b.column(0).slice(lo, hi - lo)), size)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["shingle"])

    counts = sample.distinct().mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    rows = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "shingle").limit(most).select("shingle").toPandas()
    return np.sort(rows.shingle.to_numpy(np.int64).view(np.uint64))


def signatures(documents: DataFrame, size: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """``doc_id, row, n, cls, head, bits``: hash of the text, size of the set, its class, its first elements, its bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                part = b.slice(lo, hi - lo)
                n, cls, head, bits = [], [], [], []
                for s in shingles(split(part.column(1)), size):
                    n.append(len(s))
                    cls.append(_class_of(s) if len(s) else None)
                    late = np.isin(s, frequent, assume_unique=True) if len(frequent) else np.zeros(len(s), bool)
                    first = len(s) + percent * len(s) // -100 + 1
                    head.append(np.concatenate([s[~late], s[late]])[:first].view(np.int64) if len(s) else np.zeros(0, np.int64))
                    bits.append(bitmap(s, bits_for(len(s))).tobytes() if len(s) else None)
                heads = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(x) for x in head])]), pa.int32()), pa.array(np.concatenate(head)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), heads, pa.array(bits, pa.binary())],
                    ["doc_id", "row", "n", "cls", "head", "bits"])

    docs = documents.select("doc_id", "text", _row())
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {key}, row long, n long, cls long, head array<long>, bits binary")


class Walker:
    """Links among the items of one block, or between two blocks."""

    def __init__(self, exact: bool, percent: int):
        self.exact, self.percent = exact, percent

    def alike(self, a: np.ndarray, n: int, b: np.ndarray, m: int) -> bool:
        """The exact test, or without whole sets whether the bitmaps leave a chance."""
        if self.exact:
            both = shared_elements(a, b)
        else:
            bits = 64 * min(len(a), len(b))
            a, b = folded(a, bits), folded(b, bits)
            both = int(np.bitwise_count(a & b).sum()) + min(n - int(np.bitwise_count(a).sum()), m - int(np.bitwise_count(b).sum()))
            both = min(both, n, m)
        return 100 * both >= self.percent * (n + m - both)

    def stars(self, ids: np.ndarray, blk: np.ndarray, size: np.ndarray, comp: np.ndarray, data: list[bytes]) -> list[tuple[int, int]]:
        """(smallest id of a component, other id) of what is linked, by what was before or now."""
        sets = [np.frombuffer(x, np.uint64) for x in data]
        if len(sets) == 2:
            one = 100 * size.min() >= self.percent * size.max() and comp[0] != comp[1]
            return [(int(ids.min()), int(ids.max()))] if one and self.alike(sets[0], int(size[0]), sets[1], int(size[1])) else []
        linked = Links(comp.tolist())
        bits = bits_for(int(np.median(size))) if self.exact else 64 * min(map(len, sets))
        maps = np.array([bitmap(x, bits) if self.exact else folded(x, bits) for x in sets])
        test = (lambda i, j: self.alike(sets[i], len(sets[i]), sets[j], len(sets[j]))) if self.exact else None
        Tree(size, maps, self.percent).walk(linked, test, blk if len(np.unique(blk)) > 1 else None)
        least: dict[int, int] = {}
        roots = [linked.find(i) for i in range(len(sets))]
        for r, i in zip(roots, ids.tolist()):
            least[r] = min(i, least.get(r, i))
        return [(least[r], i) for r, i in zip(roots, ids.tolist()) if i != least[r]]


def _by_key(items: DataFrame, keys: list[str], exact: bool, percent: int) -> DataFrame:
    """``a, b`` of the links inside each group of ``keys``; groups come sorted, one at a time."""
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker, rest = Walker(exact, percent), None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                t = pa.Table.from_batches([b])
                t = t if rest is None else pa.concat_tables([rest, t])
            elif rest is not None:
                t = rest
            else:
                return
            key = np.column_stack([t.column(k).to_numpy() for k in range(n_keys)])
            change = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            ends = [0, *change.tolist(), len(key)]
            if b is not None:  # the last group may go on
                ends.pop()
            cols = [t.column(n_keys + k).to_numpy() for k in range(4)]
            data, out = t.column(n_keys + 4).to_pylist(), []
            for lo, hi in zip(ends, ends[1:]):
                if hi - lo > 1:
                    out += walker.stars(*(c[lo:hi] for c in cols), data[lo:hi])
            rest = t.slice(ends[-1]).combine_chunks()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])

    ready = items.repartition(*keys).sortWithinPartitions(*keys)
    rows = [F.col(k).alias(f"key{i}") for i, k in enumerate(keys)] + [F.col(c) for c in ("cls", "blk", "n", "comp", "data")]
    return ready.select(*rows).mapInArrow(run, "a long, b long")


def links_in_groups(items: DataFrame, exact: bool, percent: int, block: int = BLOCK) -> DataFrame:
    """``a, b``: pairs of items that link all that is linked inside the groups of ``items``.

    ``items`` has ``grp, cls, n, data`` and the number of ``members`` of the group
    (written before: it is read several times). Inside a group the pairs returned
    connect what all pairs that pass would connect.
    """
    cut = items.where("members > 1").withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    cut = cut.withColumn("blk", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    links = saved(_by_key(cut.withColumn("comp", F.col("cls")), ["grp", "blk"], exact, percent))
    if items.where(F.col("members") > block).isEmpty():
        return links

    wide = saved(cut.where("blocks > 1").select("grp", "blk", "cls", "n", "data"))
    order = Window.partitionBy("grp").orderBy(F.xxhash64("cls"))
    hubs = wide.withColumn("k", F.row_number().over(order)).where(F.col("k") <= HUBS).select(
        "grp", F.col("cls").alias("hub"), F.col("n").alias("hub_n"), F.col("data").alias("hub_data"))
    apart = (100 * F.least("n", "hub_n") < percent * F.greatest("n", "hub_n")) | (F.col("cls") == F.col("hub"))
    tried = wide.join(hubs, "grp").where(~apart).select("cls", "n", "data", "hub", "hub_n", "hub_data")

    def against_hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker, view = Walker(exact, percent), lambda x: np.frombuffer(x, np.uint64)
        for b in batches:
            keep = [walker.alike(view(d), n, view(e), m) for n, d, m, e in zip(*(b.column(k).to_pylist() for k in (1, 2, 4, 5)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    comp = saved(components(links.union(tried.mapInArrow(against_hubs, "a long, b long")), True), light=True)
    wide = wide.join(comp.select(F.col("node").alias("cls"), F.col("component").alias("comp")), "cls", "left").select(
        "grp", "cls", "n", F.coalesce("comp", "cls").alias("comp"), "data")
    # what is left: items outside a group's largest component, against all others of the group
    tally = wide.groupBy("grp", "comp").agg(F.count("*").alias("k"))
    tally = tally.groupBy("grp").agg(F.max_by("comp", "k").alias("major"), F.max("k").alias("inside"), F.sum("k").alias("all"))
    tally = tally.where(F.col("all") > F.col("inside")).select(
        "grp", "major", F.ceil(F.col("inside") / block).cast("int").alias("inner"),
        F.ceil((F.col("all") - F.col("inside")) / block).cast("int").alias("outer"))
    cell = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    placed = wide.join(tally, "grp").withColumn(
        "blk", F.when(F.col("comp") == F.col("major"), -1 - cell("inner")).otherwise(cell("outer")))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    pair = lambda p, q: F.struct(p.alias("p"), q.alias("q"))
    visits = F.when(F.col("blk") < 0, F.transform(every("outer"), lambda o: pair(o, F.col("blk")))).otherwise(F.concat(
        F.transform(every("outer"), lambda o: pair(F.least(o, F.col("blk")), F.greatest(o, F.col("blk")))),
        F.transform(every("inner"), lambda i: pair(F.col("blk"), -1 - i))))
    both = placed.select("grp", F.explode(visits).alias("at"), "cls", "blk", "n", "comp", "data").select(
        "grp", "at.p", "at.q", "cls", "blk", "n", "comp", "data")
    return comp.toDF("a", "b").union(_by_key(both, ["grp", "p", "q"], exact, percent))


def linked_rows(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, row, n_shingles, key`` of every row of ``documents``: rows reachable by links share a ``key``.

    ``row`` is a hash of the text, so rows of one id keep apart; ids, also null ones,
    play no part in what is linked. The ``key`` of a text without words is null.
    """
    docs = documents.select("doc_id", "text", _row())
    signed = saved(signatures(docs, size, percent, frequent_shingles(docs, size)))
    classes = signed.where("n > 0").groupBy("cls").agg(
        F.first("n").alias("n"), F.first("head").alias("head"))
    heads = classes.select("cls", "n", F.explode("head").alias("element"))
    own = Window.partitionBy("element")
    # groups with the same members have the same sum of hashes, and are kept once
    listed = lambda over: F.xxhash64(F.count("*").over(over), F.sum(F.xxhash64("cls") % (1 << 40)).over(over))
    shared = heads.select("cls", "n", F.count("*").over(own).alias("members"), listed(own).alias("grp"), F.min("cls").over(own).alias("hub"))
    lists = saved(shared.where("members > 1").groupBy("grp", "hub", "cls", "n").agg(F.count("*").alias("elements")))
    # a class that shares half of its first elements with the first of its groups is a candidate without a walk
    plain = lists.where("cls <> hub").groupBy(F.col("cls").alias("a"), F.col("hub").alias("b")).agg(
        F.sum("elements").alias("both"), F.first("n").alias("n"))
    plain = saved(plain.where(F.col("both") * 200 >= F.col("n") * (100 - percent)).select("a", "b"), light=True)
    near = components(plain, True).toDF("cls", "comp")
    # sets that overlap enough have sizes in the same class of sizes or the next
    width = F.floor(F.log("n") / F.lit(math.log(100 / percent) * (1 + 1e-9))).cast("int")
    sized = lists.join(near, "cls", "left").select(
        "grp", "cls", F.coalesce("comp", "cls").alias("comp"), F.explode(F.array(width, width + 1)).alias("w"))
    alike = Window.partitionBy("grp", "w")
    groups = sized.select("cls", (F.min("comp").over(alike) < F.max("comp").over(alike)).alias("open"), listed(alike).alias("grp"),
                          F.count("*").over(alike).alias("members"))
    bits = signed.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("data"))
    groups = groups.where("open").select("grp", "members", "cls").distinct()
    items = saved(groups.join(bits, "cls").select("grp", "members", "cls", "n", "data"))
    unit = saved(components(links_in_groups(items, False, percent).union(plain), True).select(
        F.col("node").alias("cls"), F.col("component").alias("grp")), light=True)
    unit = unit.join(unit.groupBy("grp").agg(F.count("*").alias("members")), "grp")

    named = signed.where("n > 0").select("doc_id", "row", "cls").join(unit, "cls").groupBy("cls", "grp", "members").agg(_first_row())
    named = named.select("cls", "grp", "members", "first.doc_id", "first.row")
    texts = docs.join(named.hint("shuffle_hash"), _same_row(docs, named)).select("cls", "grp", "text", "members")

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(2)):
                part = b.slice(lo, hi - lo)
                sets = shingles(split(part.column(2)), size)
                # a hash may stand for other texts too
                right = [i for i, (s, c) in enumerate(zip(sets, part.column(0).to_pylist())) if len(s) and _class_of(s) == c]
                at = pa.array(right, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column(1).take(at), part.column(3).take(at), part.column(0).take(at),
                    pa.array([len(sets[i]) for i in right], pa.int64()),
                    pa.array([sets[i].tobytes() for i in right], pa.binary())], ["grp", "members", "cls", "n", "data"])

    sets = saved(texts.mapInArrow(whole_sets, "grp long, members long, cls long, n long, data binary").dropDuplicates(["cls"]))
    linked = components(links_in_groups(sets, True, percent), True)
    return signed.select("doc_id", "row", F.col("n").alias("n_shingles"), "cls").join(
        linked.withColumnRenamed("node", "cls"), "cls", "left").select(
        "doc_id", "row", "n_shingles", F.coalesce("component", "cls").alias("key"))


def near_copy_components(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``documents`` (``doc_id``, ``text``).

    Words are the runs of bytes other than white space, A-Z in lower case. The
    set of a text are its distinct runs of ``size`` words; of a shorter text its
    whole sequence; an empty or null text has none and is linked with nothing.
    Two documents link if they share ``percent`` of the union. ``component_id`` is
    the smallest id among all documents reachable by links; null ids are never the
    smallest while another is there. Rows keep their number, repeated ids too.
    """
    named = linked_rows(documents, size, percent)
    # written, so that the join has an exchange of its own on either side and a large component can be split
    least = saved(named.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("component_id")), light=True)
    return named.join(least, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``documents``, all columns: that with the smallest id.

    Rows of one id are kept apart by a hash of their text; of rows equal in both one
    stays. Rows without an id stay and link what they are near copies of. Rows
    without words are linked with nothing.
    """
    keyed = linked_rows(documents, size, percent).where("key IS NOT NULL AND doc_id IS NOT NULL")
    kept = keyed.groupBy("key").agg(_first_row()).select("first.doc_id", "first.row")
    held = documents.withColumn("_columns", F.struct(*[F.col(f"`{c}`") for c in documents.columns])).select("doc_id", "text", _row(), "_columns")
    named = held.where("doc_id IS NOT NULL")
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = named.where(words).join(kept, ["doc_id", "row"], "left_semi").select("doc_id", "row", "_columns")
    one = one.union(named.where(~words).select("doc_id", "row", "_columns"))
    one = one.groupBy("doc_id", "row").agg(F.min_by("_columns", F.xxhash64("_columns")).alias("_columns"))
    return one.select("_columns.*").union(held.where("doc_id IS NULL").select("_columns.*"))


@query("op8_near_copies")
def op8_near_copies(spark, folder):
    return near_copy_components(table(spark, folder, "documents", "doc_id", "text"))
