"""Problem 8: passages of test items inside a training corpus, by a generalised suffix automaton.

The automaton holds every run of tokens of the normalised test items (words; letters and digits one by one
for Han and kana passages). It is built once per block of items on the driver, flattened to sorted arrays and
broadcast. Runs of known tokens of a batch of documents are streamed through it side by side in numpy, tracking for each
the length of the longest run that ends here and occurs in some item; where it reaches the limit, the items
are those of the state that owns the run's last `limit` tokens. Windows that overlap make a span.

Spans come out with their place in the text, their length, and the share of the item that the document's
spans cover; `clean` removes those beyond a limit of length or of coverage.

Only the test items reach the driver, one block at a time. A block has at most `BLOCK_TOKENS` tokens (about 60 bytes
each when flat), and one pass over the corpus serves `PASS_BLOCKS` blocks, so that the broadcast is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm import units
from siftline.session import materialise

WORDS, LETTERS = 13, 24
BLOCK_TOKENS, PASS_BLOCKS = 500_000, 8
PIECE = 256  # tokens of a run that are stepped through at a time
SPANS = "item_id bigint, doc_id bigint, span_start int, span_end int, tokens int, item_tokens int, by_letter boolean"


class SuffixAutomaton:
    """Of several token sequences; each state of at least `limit` tokens knows the items in which its runs occur."""

    def __init__(self, sequences: list[tuple[int, list[int]]], limit: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        owners: dict[int, set[int]] = {}
        for item, tokens in sequences:
            last = 0
            for t in tokens:
                last = self._extend(last, t)
                if self.length[last] >= limit:
                    owners.setdefault(last, set()).add(item)
        order = sorted(range(1, len(self.next)), key=lambda s: -self.length[s])
        for s in order:
            up = self.link[s]
            if s in owners and up > 0 and self.length[up] >= limit:
                owners.setdefault(up, set()).update(owners[s])
        # The state that owns the last `limit` tokens of a run that is at least so long.
        self.top = list(range(len(self.next)))
        for s in reversed(order):
            up = self.link[s]
            if up > 0 and self.length[up] >= limit:
                self.top[s] = self.top[up]
        self.items = {s: sorted(owners[s]) for s in set(self.top) if s in owners}

    def _extend(self, last: int, t: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if t in nxt[last]:
            q = nxt[last][t]
            return q if length[q] == length[last] + 1 else self._clone(last, t, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and t not in nxt[p]:
            nxt[p][t] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][t]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, t, q)
        return cur

    def _clone(self, p: int, t: int, q: int) -> int:
        c = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = c
        while p >= 0 and self.next[p].get(t) == q:
            self.next[p][t] = c
            p = self.link[p]
        return c


@dataclass
class FlatAutomaton:
    """The automaton as arrays: transitions sorted by (state, token), and the items of each top state."""

    vocab: np.ndarray  # token values, sorted
    limit: int
    by_letter: bool
    keys: np.ndarray  # state * len(vocab) + token
    target: np.ndarray
    link: np.ndarray
    length: np.ndarray
    top: np.ndarray
    item_start: np.ndarray  # of each state in items
    items: np.ndarray
    item_tokens: np.ndarray  # of each entry of items

    def windows(self, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end, state): places in ids before which `limit` tokens of an item end, with the state that knows the items.

        Runs are cut into pieces that overlap by limit - 1 tokens, and all pieces are stepped through together.
        """
        step = PIECE - self.limit + 1 if self.limit < PIECE // 2 else PIECE
        piece = step + self.limit - 1
        count = np.maximum(1, -(-(size - self.limit + 1) // step))
        run = np.repeat(np.arange(len(begin)), count)
        k = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        start = begin[run] + k * step
        length = np.minimum(piece, begin[run] + size[run] - start)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        state, matched = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        ends, states = [], []
        alive = len(start)
        for i in range(int(length[0]) if len(length) else 0):
            while alive and length[alive - 1] <= i:
                alive -= 1
            token = ids[start[:alive] + i]
            left = np.arange(alive)
            while len(left):
                key = state[left] * len(self.vocab) + token[left]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                state[left[hit]] = self.target[at[hit]]
                matched[left[hit]] += 1
                left = left[~hit]
                root = state[left] == 0
                matched[left[root]] = 0
                left = left[~root]
                state[left] = self.link[state[left]]
                matched[left] = self.length[state[left]]
            full = np.flatnonzero(matched[:alive] >= self.limit)
            if len(full):
                ends.append(start[full] + i + 1)
                states.append(self.top[state[full]])
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(ends), np.concatenate(states)


def _lower(t: str | None) -> str:
    """Lower case of the same length, so that places in it are places in the text."""
    low = t.lower() if t else ""
    return low if t is None or len(low) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t)


def _tokens(texts: list, by_letter: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(value, row, begin, end) of every word, or of every letter, digit and mark, with its place in its text."""
    cp, starts = units.code_points(texts, _lower)
    if by_letter:
        begin = np.flatnonzero(units.classes()[cp])
        value, end = cp[begin].astype(np.uint64), begin + 1
    else:
        value, begin, end = units.words(cp)
    row = np.searchsorted(starts, begin, "right") - 1
    return value, row, begin - starts[row], end - starts[row]


def is_paired(passage: str) -> bool:
    """Whether most letters of a passage are Han or kana."""
    cp, _ = units.code_points([passage])
    kind = units.classes()[cp]
    return bool((kind == units.PAIRED).sum() * 2 > (kind != units.OTHER).sum())


def build(passages: list[tuple[int, str]], limit: int, by_letter: bool) -> FlatAutomaton | None:
    """The automaton of one block; None if no passage has a token."""
    values, row, _, _ = _tokens([p for _, p in passages], by_letter)
    if not len(values):
        return None
    vocab = np.unique(values)
    ids = np.searchsorted(vocab, values)
    cuts = np.searchsorted(row, np.arange(len(passages) + 1))
    a = SuffixAutomaton([(k, ids[cuts[k] : cuts[k + 1]].tolist()) for k in range(len(passages))], limit)
    counts = np.array([len(m) for m in a.next])
    key = np.repeat(np.arange(len(a.next), dtype=np.int64) * len(vocab), counts) + np.fromiter((t for m in a.next for t in m), np.int64, counts.sum())
    target = np.fromiter((s for m in a.next for s in m.values()), np.int32, counts.sum())
    order = np.argsort(key)
    held = [a.items.get(s, []) for s in range(len(a.next))]
    item_start = np.concatenate(([0], np.cumsum([len(h) for h in held])))
    places = np.array([k for h in held for k in h], np.int64)
    names, sizes = np.array([i for i, _ in passages], np.int64), np.diff(cuts)
    return FlatAutomaton(vocab, limit, by_letter, key[order], target[order], np.array(a.link, np.int32), np.array(a.length, np.int32), np.array(a.top, np.int32), item_start, names[places], sizes[places])


def find(automaton: FlatAutomaton, texts: list, tokens: tuple[np.ndarray, ...] | None = None) -> pd.DataFrame:
    """(row, item_id, span_start, span_end, tokens, item_tokens): all spans of the texts that stand in an item.

    A span is made of windows of `limit` tokens of one item that overlap each other.
    """
    a = automaton
    values, row, begin, end = tokens or _tokens(texts, a.by_letter)
    at = np.minimum(np.searchsorted(a.vocab, values), len(a.vocab) - 1)
    known = a.vocab[at] == values
    # Rows with at least `limit` known tokens in a row; most documents end here.
    edge = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | ~known[1:] | ~known[:-1]))) if len(row) else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, len(row)))
    good = (size >= a.limit) & known[edge] if len(edge) else np.zeros(0, bool)
    stop, state = a.windows(at, edge[good], size[good])
    n = a.item_start[state + 1] - a.item_start[state]
    stop = np.repeat(stop, n)
    entry = np.repeat(a.item_start[state], n) + np.arange(len(stop)) - np.repeat(np.cumsum(n) - n, n)
    item, whole = a.items[entry], a.item_tokens[entry]
    order = np.lexsort((stop, item, row[stop - 1]))
    stop, item, whole = stop[order], item[order], whole[order]
    rows, first = row[stop - 1], stop - a.limit
    fresh = np.ones(len(stop), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (item[1:] != item[:-1]) | (first[1:] >= stop[:-1])
    head = np.flatnonzero(fresh)
    last = np.append(head[1:], len(stop)) - 1 if len(head) else head
    lo, hi = first[head], stop[last]
    return pd.DataFrame({"row": rows[head], "item_id": item[head], "span_start": begin[lo], "span_end": end[hi - 1], "tokens": hi - lo, "item_tokens": whole[head], "by_letter": a.by_letter})


def _blocks(items: DataFrame, words: int, letters: int) -> Iterator[FlatAutomaton]:
    """Automata over the test items, which come to the driver a block at a time."""
    held: dict[bool, list[tuple[int, str]]] = {False: [], True: []}
    size = {False: 0, True: 0}
    limit = {False: words, True: letters}
    for r in items.toLocalIterator():
        kind = is_paired(r.passage)
        n = len(r.passage) if kind else len(r.passage) // 2 + 1  # tokens at most
        if held[kind] and size[kind] + n > BLOCK_TOKENS:
            yield build(held[kind], limit[kind], kind)
            held[kind], size[kind] = [], 0
        held[kind].append((r.item_id, r.passage))
        size[kind] += n
    for kind, block in held.items():
        if block:
            yield build(block, limit[kind], kind)


def leak_spans(documents: DataFrame, items: DataFrame, words: int = WORDS, letters: int = LETTERS) -> DataFrame:
    """SPANS: where a document holds `words` words in a row of a passage, or `letters` letters or digits in a row of a
    Han or kana passage; case, punctuation and spacing are ignored. span_start and span_end are code-point offsets.

    Null and empty texts and passages match nothing, as do passages shorter than the limit. Repeated
    documents come out repeatedly, repeated items once. Extra columns are ignored. No shuffle of the corpus.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")).where("doc_id is not null and text is not null")
    test = items.select(F.col("item_id").cast("bigint").alias("item_id"), "passage").where("item_id is not null and passage is not null").distinct()
    found: DataFrame | None = None
    group: list = []

    def one_pass(shared: list) -> DataFrame:
        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in units.slices(batches, "text"):
                texts, ids = b["text"].tolist(), b["doc_id"].to_numpy()
                seen: dict[bool, tuple[np.ndarray, ...]] = {}
                for s in shared:
                    a = s.value
                    if a.by_letter not in seen:
                        seen[a.by_letter] = _tokens(texts, a.by_letter)
                    got = find(a, texts, seen[a.by_letter])
                    yield got.assign(doc_id=ids[got["row"].to_numpy()])[["item_id", "doc_id", "span_start", "span_end", "tokens", "item_tokens", "by_letter"]]

        return docs.mapInPandas(search, SPANS)

    for automaton in _blocks(test, words, letters):
        if automaton is not None:
            group.append(spark.sparkContext.broadcast(automaton))
        if len(group) == PASS_BLOCKS:
            found, group = one_pass(group) if found is None else found.union(one_pass(group)), []
    if group:
        found = one_pass(group) if found is None else found.union(one_pass(group))
    return spark.createDataFrame([], SPANS) if found is None else found


def leaks(documents: DataFrame, items: DataFrame, words: int = WORDS, letters: int = LETTERS) -> DataFrame:
    """(item_id, doc_id) of every document that leaks an item, once each; see `leak_spans`."""
    return leak_spans(documents, items, words, letters).select("item_id", "doc_id").distinct()


def covered(spans: DataFrame) -> DataFrame:
    """The spans with `coverage`: tokens of all the document's spans of the item against the item's tokens, 1 at most."""
    each = spans.distinct()
    whole = each.groupBy("doc_id", "item_id").agg(F.least(F.lit(1.0), F.sum("tokens") / F.max("item_tokens")).alias("coverage"))
    return each.join(whole, ["doc_id", "item_id"])


def _without(text: str, cuts: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the union of the spans, and the number of characters taken out."""
    out, at = [], 0
    for lo, hi in sorted(cuts):
        if lo > at:
            out.append(text[at:lo])
        at = max(at, hi)
    kept = "".join([*out, text[at:]])
    return kept, len(text) - len(kept)


def clean(documents: DataFrame, items: DataFrame, max_words: int = WORDS, max_letters: int = LETTERS, max_coverage: float = 0.5, least_words: int = 8, least_letters: int = 16) -> DataFrame:
    """(doc_id, text, removed): every document without the spans over a limit; removed counts their characters.

    Spans of `least_words` words or `least_letters` letters are looked for. One is taken out if it has `max_words`
    words (`max_letters` letters) or more, or if the document's spans cover `max_coverage` of the item or more.
    Null texts stay null and are kept, as are rows with a null doc_id; documents that share a doc_id lose the spans of all of them. Only
    documents with spans are joined; the others pass through. An empty table of items removes nothing.
    """
    spans = covered(leak_spans(documents, items, least_words, least_letters))
    over = (F.col("tokens") >= F.when(F.col("by_letter"), max_letters).otherwise(max_words)) | (F.col("coverage") >= max_coverage)
    cuts = materialise(spans.where(over).groupBy("doc_id").agg(F.collect_set(F.struct("span_start", "span_end")).alias("cuts")), "cuts")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(t, 0) if t is None or c is None else _without(t, [(x["span_start"], x["span_end"]) for x in c]) for t, c in zip(b["text"], b["cuts"], strict=True)]
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": [t for t, _ in got], "removed": [n for _, n in got]})

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.join(cuts, "doc_id", "left").mapInPandas(cut, "doc_id bigint, text string, removed int")
