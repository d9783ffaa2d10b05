"""Token counts of texts for a BPE vocabulary of pieces with byte fallback.

A text is cut into pre-tokens, across whose ends no piece of the vocabulary
reaches. The distinct pre-tokens of a batch are held as one ragged array of
symbol numbers. In each round the best pair of every pre-token (lowest rank, the
leftmost of equals) is found with one segmented minimum and applied to all
pre-tokens at once; the pre-tokens without a pair left drop out. The count of a
pre-token is the number of symbols that survive, bytes for those outside the
vocabulary.

Ranks, pieces and kinds of pieces are read from the model file through the
library; the merging is done here.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.llm.tables import query, table

MARK = "▁"
#: Longer pre-tokens are merged with a heap: the same result in n log n steps instead of n rounds.
LONG = 192
#: Pre-tokens that a task remembers before it starts anew.
MEMORY = 400_000


class PieceCounter:
    """Counts tokens as the model in ``path`` gives them, without added special tokens."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        own = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        if any(sp.is_unused(i) for i in own) or sp.normalize("AＡ  b") != f"{MARK}AＡ{MARK * 2}b":
            raise ValueError("only models without normalisation and unused pieces are supported")
        pieces = {sp.id_to_piece(i): i for i in own}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces that reach over a space are not supported")
        score = {p: sp.get_score(i) for p, i in pieces.items()}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        symbols = dict.fromkeys(pieces)
        symbols.update(dict.fromkeys(c for p in pieces for c in p))
        self.symbol = {p: k for k, p in enumerate(symbols)}
        self.text = list(symbols)
        merges = {}
        for p in pieces:
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                if a in self.symbol and b in self.symbol:
                    merges[self.symbol[a], self.symbol[b]] = (rank[score[p]], self.symbol[p])
        self.merges = merges
        n = len(symbols) + 1
        keys = np.array([a * n + b for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.n, self.key = n, keys[order]
        self.rank = np.array([r for r, _ in merges.values()], np.int64)[order]
        self.into = np.array([s for _, s in merges.values()], np.int64)[order]
        # tokens of a surviving symbol: one, or its bytes if it is no piece
        self.cost = np.array([1 if p in pieces else len(p.encode()) for p in symbols] + [0], np.int64)
        # two characters that stand side by side in no piece are never merged
        chars = "".join(sorted({c for p in pieces for c in p if len(p) > 1} - {MARK}))
        inside = re.escape(chars)
        # spaces with the word after them; any other character is alone
        self.pre = re.compile(f"{MARK}*[{inside}]+|{MARK}+|[^{inside}{MARK}]+")
        self.alone = re.compile(f"[^{inside}{MARK}]")
        self.memory: dict[str, int] = {}

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], np.iinfo(np.int64).max), at

    def _merged(self, words: list[str]) -> np.ndarray:
        """Tokens of each word, all words merged in step."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.fromiter((self.symbol[c] for w in words for c in w), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(words)), size)
        count = np.zeros(len(words), np.int64)
        none = np.iinfo(np.int64).max
        # rank of the pair that begins at each symbol; the last of a word begins none
        last = np.ones(len(flat), bool)
        last[:-1] = owner[1:] != owner[:-1]
        rank, at = self._found(flat, np.append(flat[1:], 0))
        rank[last] = none
        while len(flat):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(flat)))
            done = np.repeat(best == none, length)
            np.add.at(count, owner[done], self.cost[flat[done]])
            # the leftmost best pair of each word that still has one
            chosen = np.flatnonzero((rank == np.repeat(best, length)) & ~done)
            chosen = chosen[np.append(True, owner[chosen[1:]] != owner[chosen[:-1]])] if len(chosen) else chosen
            flat[chosen] = self.into[at[chosen]]
            keep = ~done
            keep[chosen + 1] = False
            last[chosen] = last[chosen + 1]
            place = np.cumsum(keep) - 1
            now = place[chosen]
            flat, owner, last, rank, at = flat[keep], owner[keep], last[keep], rank[keep], at[keep]
            # pairs that touch a new symbol are ranked anew
            touched = np.concatenate((now, now - 1))
            touched = touched[(touched >= 0) & (touched < len(flat))]
            if len(touched):
                rank[touched], at[touched] = self._found(flat[touched], flat[np.minimum(touched + 1, len(flat) - 1)])
                rank[last] = none
        return count

    def _long(self, word: str) -> int:
        """Tokens of one long word: linked symbols and a heap of their pairs."""
        sym = [self.symbol[c] for c in word]
        after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        heap = []

        def push(i):
            j = after[i]
            if j < len(sym) and (m := self.merges.get((sym[i], sym[j]))):
                heapq.heappush(heap, (m[0], i, sym[i], sym[j], m[1]))

        for i in range(len(sym)):
            push(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if sym[i] == a else len(sym)
            if j >= len(sym) or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = new, -1, after[j]
            if after[j] < len(sym):
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return int(sum(self.cost[s] for s in sym if s >= 0))

    def _learn(self, words: set[str]) -> None:
        single, short = [], []
        for w in words:
            if self.alone.match(w):
                self.memory[w] = sum(self.cost[self.symbol[c]] if c in self.symbol else len(c.encode()) for c in w)
            elif len(w) > LONG:
                self.memory[w] = self._long(w)
            else:
                short.append(w)
        for lo in range(0, len(short), 50_000):
            part = short[lo:lo + 50_000]
            self.memory.update(zip(part, self._merged(part).tolist()))

    def counts(self, texts: list[str | None]) -> list[int]:
        if len(self.memory) > MEMORY:
            self.memory.clear()
        words = [self.pre.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = set().union(*words) - self.memory.keys()
        if new:
            self._learn(new)
        get = self.memory.__getitem__
        return [sum(map(get, w)) for w in words]


def count_tokens(documents: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``documents`` (``doc_id``, ``text``).

    Texts are counted whole; a null text is empty and has no bytes and no tokens.
    Rows keep their number and ids. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(path)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = part.column(1).to_pylist()
                n = counter.counts(texts)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()),
                ], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    docs = documents.select("doc_id", "text")
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {key}, n_bytes long, n_tokens long, over_limit boolean")


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op5_token_counts")
def op5_token_counts(spark, folder):
    return count_tokens(table(spark, folder, "documents", "doc_id", "text"), vocabulary())
