"""Benchmark items inside documents, found with a block-max BM25 index.

The test items are the indexed side: an inverted index of BM25 impacts, divided
by each item's score against itself, so that one threshold means the same for
all. Items lie in blocks; a block keeps the largest impact of each of its terms.
Every passage of every document is a query. Its terms are ordered by their
largest impact anywhere; the weakest, which together stay below the threshold,
open no block (the MaxScore form of WAND). The blocks of the others are bounded
by their maxima, and only those whose bound reaches the threshold are scored
item by item, exactly. Postings and maxima are sparse arrays. What is retrieved counts as a leak if it holds enough of
the item's question and of its answer, word sequences in order. Where an answer
is short, few runs of words decide, so the words of the passage that lie beside
the question count for the answer too, and an item of which all but a few words
stand there in order counts whole.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.llm.tables import query, saved, table
from tieproof.llm.words import SPACE, Words, chunks, split

#: Words are runs of letters, digits and bytes outside ASCII.
BREAK = SPACE | np.array([c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 128 for c in range(256)])


@dataclass(frozen=True)
class Terms:
    """How leaks are judged. ``threshold``: share of an item's own BM25 score that a passage must reach;
    ``overlap``: share of the question's and of the answer's runs of ``run`` words that its text must hold, or,
    of the answer, of its words in order beside the question. ``edits``: words of an item that may differ, if
    they are no more than a fifth of it, wherever they stand."""

    threshold: float = 0.6
    overlap: float = 0.6
    run: int = 3
    edits: int = 2
    k1: float = 1.2
    b: float = 0.75
    block: int = 8
    stride: int = 32


@dataclass(frozen=True)
class Known:
    """Of all items: their number, words in all and of the longest; of each word of a slice, sorted, how many hold it."""

    items: int
    length: float
    longest: int
    words: np.ndarray
    df: np.ndarray


def _runs(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of a shorter text, of the whole."""
    size = min(size, len(h))
    out = np.zeros(max(0, len(h) - size + 1) if size else 0, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + (h[k:len(h) - size + 1 + k] ^ (h[k:len(h) - size + 1 + k] >> np.uint64(31)))
    return out


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of all ranges, one range after the other."""
    n = hi - lo
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def _groups(counts: np.ndarray, of: np.ndarray | None = None, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose counts add up to about ``most``, at least one row; rows with equal ``of`` stay together."""
    upto = np.cumsum(counts)
    lo = 0
    while lo < len(counts):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, side="right")))
        if of is not None and hi < len(counts):
            hi = int(np.searchsorted(of, of[hi - 1], side="right"))
        yield lo, hi
        lo = hi


def _in_order(i: np.ndarray, j: np.ndarray) -> int:
    """The most pairs of which both places rise."""
    last: list[int] = []
    for b in j[np.lexsort((-j, i))].tolist():
        at = bisect.bisect_left(last, b)
        last[at:at + 1] = [b]
    return len(last)


class Index:
    """Impacts of the terms of ``texts`` (never null or empty), by term and by block of items."""

    def __init__(self, ids: list, texts: list[str], terms: Terms, known: Known | None = None):
        self.terms = terms
        words = split(pa.array(texts), space=BREAK)
        h = words.hashes()
        hashes = [h[lo:hi] for lo, hi in zip(words.first[:-1], words.first[1:])]
        kept = [i for i, w in enumerate(hashes) if len(w)]
        # items of like vocabulary share blocks: the order is that of their rarest words' languages, taken
        # from the commonest word that they hold
        every, times = np.unique(np.concatenate([h, np.zeros(0, np.uint64)]), return_counts=True)
        common = {int(w): int(n) for w, n in zip(every, times)}
        kept.sort(key=lambda i: (max((common[int(w)], int(w)) for w in hashes[i]), ids[i]))
        self.ids, hashes = [ids[i] for i in kept], [hashes[i] for i in kept]
        self.vocabulary = every
        lengths = np.array([len(w) for w in hashes], float)
        t, d, tf = [], [], []
        for i, w in enumerate(hashes):
            u, n = np.unique(np.searchsorted(every, w), return_counts=True)
            t.append(u), d.append(np.full(len(u), i)), tf.append(n)
        t, d, tf = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (t, d, tf))
        known = known or Known(len(hashes), float(lengths.sum()), int(lengths.max(initial=1)), every, np.bincount(t, minlength=len(every)))
        self.width = known.longest + terms.edits + terms.stride
        df = known.df[np.searchsorted(known.words, every)]
        idf = np.log(1 + (known.items - df + 0.5) / (df + 0.5))
        mean = max(known.length / max(known.items, 1), 1)
        impact = idf[t] * tf * (terms.k1 + 1) / (tf + terms.k1 * (1 - terms.b + terms.b * lengths[d] / mean))
        own = np.bincount(d, impact, len(hashes))
        impact = (impact / own[d] if len(d) else impact).astype(np.float32)
        self.blocks = max(1, -(-len(hashes) // terms.block))
        # terms are numbered by their largest impact, the weakest first
        most = np.zeros(len(every), np.float32)
        np.maximum.at(most, t, impact)
        self.number = np.empty(len(every), np.int64)
        self.number[np.argsort(most, kind="stable")] = np.arange(len(every))
        self.most = np.sort(most).astype(float)
        # postings by term and item; where each (term, block) begins in them, and its maximum
        order = np.lexsort((d, self.number[t]))
        self.item, self.weight = d[order].astype(np.int32), impact[order]
        place = self.number[t][order] * self.blocks + d[order] // terms.block
        self.place, at = np.unique(place, return_index=True)
        self.posting = np.append(at, len(place)).astype(np.int64)
        self.place_most = np.maximum.reduceat(self.weight, at) if len(at) else self.weight
        # places of a small index are looked up directly (at most 16 MB), others by search
        self.direct = None
        if len(every) * self.blocks <= 4 << 20:
            self.direct = np.full(len(every) * self.blocks, -1, np.int32)
            self.direct[self.place] = np.arange(len(self.place))
        self.list = np.searchsorted(self.place, np.arange(len(every) + 1) * self.blocks)
        self.words, self.cut, self.question, self.answer = hashes, [], [], []
        for i, k in enumerate(kept):
            cut = self._answer_at(texts[k], hashes[i])
            self.cut.append(cut)
            self.question.append(np.unique(_runs(hashes[i][:cut], terms.run)))
            self.answer.append(np.unique(_runs(hashes[i][cut:], terms.run)))
        # a direct table over the low bits of the hashes; few words share a slot with a term
        self.bits = max(16, int(len(every) * 8).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[every & np.uint64((1 << self.bits) - 1)] = True

    @property
    def impact(self) -> np.ndarray:
        """The impacts as a table, words in the order of ``vocabulary`` x items: for small indexes."""
        out = np.zeros((len(self.vocabulary), self.blocks * self.terms.block), np.float32)
        term = np.repeat(self.place // self.blocks, np.diff(self.posting))
        out[np.argsort(self.number)[term], self.item] = self.weight
        return out

    @staticmethod
    def _answer_at(text: str, h: np.ndarray) -> int:
        """Where the answer begins, in words: the last sentence, at most half of the item, or else its last quarter."""
        body = text.rstrip(" \n\t.?!:;")
        at = max(body.rfind(c) for c in ".?!:\n")
        tail = split(pa.array([body[at + 1:]]), space=BREAK)
        n = len(tail.start) if at >= 0 else 0
        if not 1 <= n <= len(h) // 2:
            n = max(1, len(h) // 4)
        return len(h) - n if len(h) > 1 else 0

    def term_of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of words that are terms, their terms)."""
        at = np.flatnonzero(self.maybe[h & np.uint64((1 << self.bits) - 1)])
        term = np.minimum(np.searchsorted(self.vocabulary, h[at]), len(self.vocabulary) - 1)
        hit = self.vocabulary[term] == h[at]
        return at[hit], self.number[term[hit]]

    def leaks(self, words: Words) -> list[tuple[int, int, float, float, float, int]]:
        """(text, item, score, question share, answer share, first word of the passage) of each pair found."""
        if not self.ids:
            return []
        h, stride, found = words.hashes(), self.terms.stride, {}
        at, term = self.term_of(h)
        n = np.diff(words.first)
        of = np.repeat(np.arange(len(n)), n)
        # strides of each text; a passage is a few strides in a row
        per_text = -(-n // stride)
        offset = np.concatenate([[0], np.cumsum(per_text)])
        here = of[at]
        stretch = offset[here] + (at - words.first[here]) // stride
        pairs = np.unique(stretch * len(self.vocabulary) + term)
        stretch, term = pairs // len(self.vocabulary), pairs % len(self.vocabulary)
        if not len(stretch):
            return []
        reach = -(-self.width // stride)
        begin = np.searchsorted(stretch, np.arange(offset[-1] + 1))
        text_of = np.repeat(np.arange(len(n)), per_text)
        passage = np.arange(offset[-1])
        lo, hi = begin[passage], begin[np.minimum(passage + reach, offset[text_of + 1])]
        for a, b in _groups(hi - lo):
            # distinct terms of each passage, the weakest first
            pairs = np.unique(np.repeat(passage[a:b], (hi - lo)[a:b]) * len(self.vocabulary) + term[_ranges(lo[a:b], hi[a:b])])
            self._visit(words, h, pairs // len(self.vocabulary), pairs % len(self.vocabulary), text_of, offset, reach, found)
        return [(t, i, *v) for (t, i), v in sorted(found.items())]

    def _places(self, want: np.ndarray) -> np.ndarray:
        """Where each (term, block) is among the places, or -1."""
        if self.direct is not None:
            return self.direct[want]
        at = np.minimum(np.searchsorted(self.place, want), len(self.place) - 1)
        return np.where(self.place[at] == want, at, -1)

    def _visit(self, words, h, passage, term, text_of, offset, reach, found) -> None:
        """Bounds the blocks that the strong terms of each passage open, scores those that may reach the threshold."""
        least = self.terms.threshold - 1e-4
        used, first = np.unique(passage, return_index=True)
        after = np.append(first[1:], len(passage))
        upto = np.cumsum(self.most[term])
        upto -= np.repeat(np.concatenate([[0], upto])[first], after - first)
        strong = np.flatnonzero(upto >= least)
        lists = np.diff(self.list)[term[strong]]
        for a, b in _groups(lists, np.searchsorted(used, passage[strong])):
            some = strong[a:b]
            at = _ranges(self.list[term[some]], self.list[term[some] + 1])
            key = np.repeat(passage[some], lists[a:b]) * self.blocks + self.place[at] % self.blocks
            key, of = np.unique(key, return_inverse=True)
            bound = np.bincount(of, self.place_most[at], len(key))
            p = np.searchsorted(used, key // self.blocks)
            # the weak terms of a passage add less than the last sum before its first strong one
            s = np.searchsorted(strong, first[p])
            weak = np.where(strong[s] > first[p], upto[strong[s] - 1], 0.0)
            may = bound + weak >= least
            key, p = key[may], p[may]
            for c, e in _groups(after[p] - first[p]):
                self._score_blocks(words, h, key[c:e], first[p[c:e]], after[p[c:e]], term, upto, text_of, offset, reach, found)

    def _score_blocks(self, words, h, key, lo, hi, term, upto, text_of, offset, reach, found) -> None:
        """Scores the items of each passage and block and verifies those that reach the threshold."""
        if not len(key) or not len(self.place):
            return
        size, stride = self.terms.block, self.terms.stride
        # the strongest terms first; a block is left as soon as the others can't lift it to the threshold
        left, bound, ats, ofs, end = np.arange(len(key)), np.zeros(len(key)), [], [], hi
        while len(left):
            begin = np.maximum(lo[left], end - np.maximum(8, (hi - lo)[left] // 4))
            want = term[_ranges(begin, end)] * self.blocks + np.repeat(key[left] % self.blocks, end - begin)
            of = np.repeat(left, end - begin)
            at = self._places(want)
            hit = at >= 0
            ats.append(at[hit]), ofs.append(of[hit])
            bound += np.bincount(ofs[-1], self.place_most[ats[-1]], len(key))
            more = begin > lo[left]
            rest = np.where(more, upto[begin - 1], 0.0)
            bound[left[bound[left] + rest < self.terms.threshold - 1e-4]] = -1e9
            some = more & (bound[left] >= 0)
            left, end = left[some], begin[some]
        at, of = np.concatenate(ats), np.concatenate(ofs)
        may = bound >= 0
        at, of = at[may[of]], of[may[of]]
        posting = _ranges(self.posting[at], self.posting[at + 1])
        of = np.repeat(of, self.posting[at + 1] - self.posting[at])
        score = np.bincount(of * size + self.item[posting] % size, self.weight[posting].astype(float), len(key) * size)
        for c in np.flatnonzero(score >= self.terms.threshold - 1e-6):
            passage, block = divmod(int(key[c // size]), self.blocks)
            item, text, best = block * size + int(c % size), int(text_of[passage]), float(score[c])
            if (text, item) in found and found[text, item][0] >= best:
                continue
            start = int(passage - offset[text]) * stride
            begins = words.first[text] + start
            shares = self._judged(h[begins:min(begins + reach * stride, words.first[text + 1])], item)
            if shares:
                found[text, item] = (best, *shares, start)

    def _judged(self, h: np.ndarray, item: int) -> tuple[float, float] | None:
        """Question and answer share of a passage that leaks the item, else None."""
        question, answer = self._shares(h, item)
        if min(question, answer) >= self.terms.overlap:
            return question, answer
        w, cut, edits = self.words[item], self.cut[item], self.terms.edits
        # places (in the item, in the passage) of equal words; the item lies along the diagonal with most of them
        order = np.argsort(h, kind="stable")
        lo, hi = (np.searchsorted(h[order], w, side) for side in ("left", "right"))
        i = np.repeat(np.arange(len(w)), hi - lo)
        if not len(i):
            return None
        j = order[np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange(len(i))]
        near = np.convolve(np.bincount(j - i + len(w), minlength=len(w) + len(h)), np.ones(2 * edits + 1, int), "same")
        band = np.abs(j - i + len(w) - int(near.argmax())) <= edits
        i, j = i[band], j[band]
        differ = len(w) - _in_order(i, j)
        tail = _in_order(i[i >= cut], j[i >= cut]) / (len(w) - cut)
        if differ <= min(edits, len(w) // 5) or question >= self.terms.overlap and tail >= self.terms.overlap:
            return question, max(answer, tail)
        return None

    def _shares(self, h: np.ndarray, item: int) -> tuple[float, float]:
        out = []
        for want in (self.question[item], self.answer[item]):
            size = self.terms.run
            n = len(want)
            if not n:
                out.append(1.0)
                continue
            have = np.unique(_runs(h, size))
            share = np.isin(want, have).mean()
            if share == 0 and n == 1:  # a question or answer shorter than a run is one shorter run
                share = max(float(np.isin(want, _runs(h, k)).any()) for k in range(1, size + 1))
            out.append(float(share))
        return out[0], out[1]


def item_slices(items: DataFrame, most: int = 20_000, size: int = 16 << 20) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of all items, at most ``most`` and ``size`` bytes of text (or one item) at a time: what one
    index holds and is sent to tasks. An index has fewer postings than bytes of text."""
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    ids, texts, held = [], [], 0
    for i, text in items.orderBy("item_id", "text").toLocalIterator():
        n = len(text.encode("utf-8", "surrogatepass"))
        if ids and (len(ids) == most or held + n > size):
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(i), texts.append(text)
        held += n
    yield ids, texts


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in chunks(b.column(0)):
            words = split(b.column(0).slice(lo, hi - lo), space=BREAK)
            h = words.hashes().view(np.int64)
            each = [h[a:z] for a, z in zip(words.first[:-1], words.first[1:]) if z > a]
            yield pa.RecordBatch.from_arrays([pa.array([len(w) for w in each], pa.int64()),
                                              pa.array([np.unique(w) for w in each], pa.list_(pa.int64()))], ["n", "words"])


def known_slices(items: DataFrame, **bounds) -> Iterator[tuple[list, list[str], Known | None]]:
    """The slices, one at a time, with the statistics of all items, so that scores do not depend on how items are cut.

    The driver holds the slice at hand and the one after it; counts of words stay in
    Spark, and of them only those of the slice's own words come back.
    """
    slices = item_slices(items, **bounds)
    held = next(slices)
    after = next(slices, None)
    if after is None:
        yield (*held, None)
        return
    spark = items.sparkSession
    counted = saved(items.where("item_id IS NOT NULL AND text IS NOT NULL").select("text").mapInArrow(_item_words, "n long, words array<long>"))
    number, length, longest = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(1))).first()
    counts = saved(counted.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df")))
    while held is not None:
        own = np.unique(split(pa.array(held[1], pa.string()), space=BREAK).hashes())
        df = counts.join(spark.createDataFrame(pa.table({"word": own.view(np.int64)})), "word").toArrow()
        times = df["df"].to_numpy()[np.argsort(df["word"].to_numpy().view(np.uint64))]
        yield (*held, Known(number, float(length), longest, own, times))
        held, after = after, next(slices, None) if after is not None else None


def find_leaks(documents: DataFrame, items: DataFrame, terms: Terms = Terms()) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, first_word``: the items each document leaks.

    ``documents`` has ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``. One
    row per row of ``documents`` and item found, with its best passage. A passage is
    a window over the words of the whole text, long enough that every item lies
    whole in one. Null or empty texts and items leak nothing; null ids of documents
    are kept, items without an id left out. Nothing is shuffled.
    """
    parts = []
    docs = documents.select("doc_id", "text")
    key, item_key = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    for ids, texts, known in known_slices(items):

        def run(batches: Iterator[pa.RecordBatch], ids=ids, texts=texts, known=known) -> Iterator[pa.RecordBatch]:
            index = Index(ids, texts, terms, known)
            for b in batches:
                for lo, hi in chunks(b.column(1)):
                    part = b.slice(lo, hi - lo)
                    rows = index.leaks(split(part.column(1), space=BREAK))
                    if rows:
                        at, item, score, question, answer, first = zip(*rows)
                        yield pa.RecordBatch.from_arrays([
                            part.column(0).take(pa.array(at)), pa.array([index.ids[i] for i in item]), pa.array(score),
                            pa.array(question), pa.array(answer), pa.array(first, pa.int32()),
                        ], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])

        part = docs.mapInArrow(run, f"doc_id {key}, item_id {item_key}, score double, question_overlap double, "
                                    "answer_overlap double, first_word int")
        # written, so that the driver holds no slice longer than it is at work
        parts.append(part if known is None else saved(part))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def keep_clean(documents: DataFrame, items: DataFrame, terms: Terms = Terms()) -> DataFrame:
    """The rows of ``documents`` that leak no item, all columns."""
    at = documents.columns.index("text")
    out = documents
    for ids, texts, known in known_slices(items):

        def run(batches: Iterator[pa.RecordBatch], ids=ids, texts=texts, known=known) -> Iterator[pa.RecordBatch]:
            index = Index(ids, texts, terms, known)
            for b in batches:
                for lo, hi in chunks(b.column(at)):
                    part = b.slice(lo, hi - lo)
                    keep = np.ones(hi - lo, bool)
                    keep[[r[0] for r in index.leaks(split(part.column(at), space=BREAK))]] = False
                    yield part.filter(pa.array(keep))

        out = out.mapInArrow(run, documents.schema)
        out = out if known is None else saved(out)
    return out


@query("op10_decontamination")
def op10_decontamination(spark, folder):
    return find_leaks(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"))
