"""Problem 1: the language of every row and stretch, by a byte convolutional network in numpy.

Texts are lower-cased and cut into sentences; tags, mentions, links, times and numbers are masked. Each
sentence's UTF-8 bytes are read in windows of `WINDOW` bytes: filters of several widths over one-hot bytes,
a maximum over the window's positions, and a softmax over the languages and "no language" (names). A
sentence takes the mean of its windows; neighbours in one language form a stretch.

The network is trained on at most `SAMPLE` rows of each label, chosen by hash, their sentences carrying the
row's label. A sentence counts as language if it has several words that many rows of the sample use, or a
long run of letters (scripts without blanks); one with none of either, and lists made from the sample's tags,
train "no language". Labels may be wrong and rows mixed: a sentence only trains its row's label if its words,
counted over all rows of the sample, speak for that label more than for any other.
Training is deterministic; inference covers whole texts, in one pass without a shuffle.
"""

from __future__ import annotations

import hashlib
import inspect
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.functions.keys import present, strip
from siftline.session import path_exists, shared_dir

LANGS = ("en", "de", "es", "fr", "pt", "it", "ru", "zh", "ja", "ko", "th", "ar")
NONE = len(LANGS)
# Names and three-letter codes of the languages.
NAMES = {
    "en": "english eng", "de": "german deutsch deu ger", "es": "spanish español spa", "fr": "french français fra fre",
    "pt": "portuguese português por", "it": "italian italiano ita", "ru": "russian русский rus", "zh": "chinese 中文 zho chi",
    "ja": "japanese 日本語 jpn", "ko": "korean 한국어 kor", "th": "thai ไทย tha", "ar": "arabic العربية ara",
}
SAMPLE = 1000  # labelled rows of each language to train on, at most
COMMON_ROWS = 10  # rows of the sample that use a common word
_TOKEN = re.compile(r"[^\s,.:;!?()\[\]|/&+»★・、。！？؟\-]+")
WINDOW, CROP = 96, 64  # bytes of a window, and of the random parts of windows in training
WIDTHS = ((2, 8), (3, 24), (4, 32), (5, 16))  # (bytes, filters)
FILTERS, REACH = sum(f for _, f in WIDTHS), max(w for w, _ in WIDTHS)
SMOOTH = 0.1  # of a training label's weight goes to all classes alike
MIN_BYTES = 8  # of letters, for a sentence to be judged at all
MIN_MAIN, MIN_OTHER = 0.3, 0.6  # confidence that a sentence needs, in the row's main language and in another
NAME = 16  # characters of a token that can still be a name in a list
MIN_SHARE = 0.5  # of a sentence in another language that is not masked
STRETCHES = "row_id bigint, field_name string, stretch_start int, stretch_end int, lang string, confidence double, first boolean, label string, used array<string>"


def label_code(c: Column | str) -> Column:
    """The two-letter code that a label names, with or without region; null if it names none of LANGS."""
    key = F.lower(F.regexp_extract(strip(c), r"^([^-_]*)", 1))
    pairs = [F.lit(x) for code, names in NAMES.items() for name in (code, *names.split()) for x in (name, code)]
    return F.create_map(*pairs)[key]


@dataclass
class Sentences:
    """Sentences of a batch of texts: padded bytes, windows over them, and where each came from."""

    data: np.ndarray  # bytes, REACH zeros after each window's sentence
    starts: np.ndarray  # of the windows in data
    sentence: np.ndarray  # of each window
    size: np.ndarray  # bytes of each window
    row: np.ndarray  # of each sentence
    begin: np.ndarray  # code point offsets of each sentence in its text
    end: np.ndarray
    share: np.ndarray  # of each sentence's bytes that are not masked

    def sentence_sizes(self) -> np.ndarray:
        return np.bincount(self.sentence, weights=self.size, minlength=len(self.row))


def _lower(t: str | None) -> str:
    if not t:
        return ""
    low = t.lower()
    return low if len(low) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t)


def _in(cp: np.ndarray, chars: str) -> np.ndarray:
    out = np.zeros(len(cp), bool)
    for c in chars:
        out |= cp == ord(c)
    return out


def cut(texts: list) -> Sentences:
    """All sentences with at least MIN_BYTES bytes left after masking."""
    low = [_lower(t) for t in texts]
    joined = "\n".join(low) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.zeros(len(low), np.int64)
    first[1:] = np.cumsum([len(t) + 1 for t in low[:-1]])
    blank = _in(cp, " \t\n\r\x0b\x0c\xa0　")
    after = np.append(blank[1:], True)
    before = np.concatenate(([True], blank[:-1]))
    ends = _in(cp, "\n\r  。！？؟") | (_in(cp, ".!?…") & after)
    thai = (cp >= 0x0E01) & (cp <= 0x0E5B)
    ends |= blank & np.concatenate(([False], thai[:-1])) & np.append(thai[1:], False)
    # Tokens that begin with a tag or mention sign or a digit, and links, carry no language.
    token = np.cumsum(before & ~blank)
    opens = np.flatnonzero(before & ~blank)
    drop = np.zeros(len(opens) + 1, bool)
    if len(opens):
        head = cp[opens]
        link = _in(head, "hw") & (cp[np.minimum(opens + 1, len(cp) - 1)] == np.where(head == ord("h"), ord("t"), ord("w"))) & (cp[np.minimum(opens + 2, len(cp) - 1)] == np.where(head == ord("h"), ord("t"), ord("w")))
        drop[1:] = _in(head, "#@0123456789") | link
    # So do names in lists: next to a list sign, after a time, or between two commas.
    if len(opens) > 2:
        closes = np.flatnonzero(after & ~blank)
        alone = opens == closes
        sign = alone & _in(head, "&+/»★•·・|-–—")
        line = np.cumsum(_in(cp, "\n\r"))[opens]
        near = line[1:] == line[:-1]
        time = _in(head, "0123456789") & (cp[np.minimum(opens + 2, len(cp) - 1)] == ord(":"))
        comma = _in(cp[closes], ",،、")
        joins = alone & _in(head, "&+/")
        listed = np.zeros(len(opens) + 1, bool)
        listed[1:] |= sign
        listed[1:-1] |= joins[1:] & near
        listed[2:] |= (sign | time)[:-1] & near
        listed[2:] |= comma[1:] & comma[:-1] & near
        listed[1:-1] |= comma[1:] & comma[:-1] & near
        last = np.append(~near[1:], True)
        listed[2:] |= comma[:-1] & near & last & listed[1:-1]
        start = np.concatenate(([True], ~near))
        pair = start[:-1] & comma[:-1] & near & last  # a line of two names
        listed[1:-1] |= pair
        listed[2:] |= pair
        listed[1:] &= closes - opens < NAME  # in scripts without blanks a token may be a sentence
        drop |= listed
    keep = ~(drop[token] & ~blank)
    seg = np.concatenate(([0], np.cumsum(ends)[:-1]))
    width = 1 + (cp >= 0x80).astype(np.int8) + (cp >= 0x800) + (cp >= 0x10000)
    raw = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    use = np.repeat(keep & ~_in(cp, "\n\r"), width)
    data, of = raw[use], np.repeat(seg, width)[use]
    solid = np.repeat(~blank, width)
    share = np.bincount(of, weights=solid[use], minlength=int(seg[-1]) + 1) / np.maximum(np.bincount(np.repeat(seg, width), weights=solid), 1)
    letters = np.bincount(of, weights=(data >= 0x61), minlength=int(seg[-1]) + 1)
    good = letters >= MIN_BYTES
    sel = good[of]
    data, of = data[sel], of[sel]
    number = np.cumsum(good) - 1
    of = number[of]
    n = int(good.sum())
    edges = np.flatnonzero(np.concatenate(([True], ends[:-1])))[: int(seg[-1]) + 1]
    stops = np.append(edges[1:], len(cp))
    edges, stops = edges[good], stops[good]
    row = np.searchsorted(first, edges, "right") - 1
    padded = np.zeros(len(data) + REACH * (n + 1), np.uint8)
    at = np.arange(len(data)) + REACH * of
    padded[at] = data
    lo = np.searchsorted(of, np.arange(n))
    hi = np.searchsorted(of, np.arange(n), "right")
    count = -(-(hi - lo) // WINDOW)
    sentence = np.repeat(np.arange(n), count)
    k = np.arange(len(sentence)) - np.repeat(np.cumsum(count) - count, count)
    begin = lo[sentence] + k * WINDOW
    size = np.minimum(WINDOW, hi[sentence] - begin)
    return Sentences(padded, begin + REACH * sentence, sentence, size, row, edges - first[row], np.minimum(stops - first[row], np.array([len(t) for t in low])[row]), share[good])


class ByteCNN:
    """One layer of byte filters of several widths, maximum over the window, softmax."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mask = np.zeros((REACH, 1, FILTERS), np.float32)
        at = 0
        for w, f in WIDTHS:
            self.mask[:w, :, at : at + f] = 1
            at += f
        self.conv = (rng.normal(0, 0.25, (REACH, 256, FILTERS)) * self.mask).astype(np.float32)
        self.conv[:, 0] = 0
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.2, (FILTERS, NONE + 1)).astype(np.float32)
        self.base = np.zeros(NONE + 1, np.float32)

    def responses(self, x: np.ndarray, n: int) -> np.ndarray:
        """Filter responses at the first n positions of bytes x (n + REACH - 1 or more)."""
        r = self.conv[0][x[:n]]
        for k in range(1, REACH):
            r += self.conv[k][x[k : k + n]]
        return r

    def pooled(self, s: Sentences, step: int = 6000) -> np.ndarray:
        """(windows, FILTERS): the maxima, rectified."""
        out = np.empty((len(s.starts), FILTERS), np.float32)
        x = np.append(s.data, np.zeros(REACH, np.uint8))
        stop = s.starts + s.size
        a = 0
        while a < len(s.starts):
            b = max(a + 1, int(np.searchsorted(stop, s.starts[a] + step)))
            lo, hi = int(s.starts[a]), int(stop[b - 1])
            # Between windows lie only the padding positions of a sentence's end, which add partial matches at most.
            out[a:b] = np.maximum.reduceat(self.responses(x[lo : hi + REACH], hi - lo), s.starts[a:b] - lo)
            a = b
        return np.maximum(out + self.bias, 0)

    def probabilities(self, s: Sentences) -> np.ndarray:
        """(sentences, classes): the windows' softmax, averaged by their bytes."""
        z = self.pooled(s) @ self.out + self.base
        z = np.exp(z - z.max(1, keepdims=True))
        p = z / z.sum(1, keepdims=True) * s.size[:, None]
        cuts = np.flatnonzero(np.concatenate(([True], s.sentence[1:] != s.sentence[:-1]))) if len(p) else np.zeros(0, int)
        total = np.add.reduceat(p, cuts) if len(p) else p
        return total / total.sum(1, keepdims=True)

    def fit(self, windows: np.ndarray, y: np.ndarray, epochs: int = 15, batch: int = 128, rate: float = 0.008, seed: int = 3) -> None:
        """Adam on cross-entropy over random crops of windows (n, WINDOW + REACH) of padded bytes.

        The rate falls linearly, pooled filters are dropped at random, and the weights kept are a running mean.
        """
        rng = np.random.default_rng(seed)
        params = [self.conv, self.bias, self.out, self.base]
        m, v, mean = ([np.zeros_like(p) for p in params] for _ in range(3))
        size, step, steps = (windows > 0).sum(1), 0, epochs * (len(y) // batch + 1)
        for epoch in range(epochs):
            order = rng.permutation(len(y))
            for i in range(0, len(order), batch):
                rows = order[i : i + batch]
                long = np.where(rng.random(len(rows)) < 0.3, rng.integers(20, CROP, len(rows)), CROP)
                at = (rng.random(len(rows)) * np.maximum(size[rows] - long + 1, 1)).astype(int)
                x = windows[rows[:, None], np.minimum(at[:, None] + np.arange(CROP + REACH), WINDOW + REACH - 1)]
                x = x * (np.arange(CROP + REACH) < long[:, None])
                live_filters = (rng.random((len(rows), FILTERS)) > 0.3) / np.float32(0.7)
                arg, h, p = self._forward(x, live_filters)
                d = p.copy()
                d -= SMOOTH / (NONE + 1)
                d[np.arange(len(rows)), y[rows]] -= 1 - SMOOTH
                d /= len(rows)
                g_out, g_base = h.T @ d, d.sum(0)
                dh = (d @ self.out.T) * (h > 0) * live_filters
                r, f = np.nonzero(dh)
                g_conv = np.empty_like(self.conv)
                for k in range(REACH):
                    g_conv[k] = np.bincount(x[r, arg[r, f] + k].astype(int) * FILTERS + f, weights=dh[r, f], minlength=256 * FILTERS).reshape(256, FILTERS)
                g_conv *= self.mask
                g_conv[:, 0] = 0
                step += 1
                lr = rate * max(0.02, 1 - step / steps)
                for j, g in enumerate((g_conv, dh.sum(0), g_out, g_base)):
                    m[j] += 0.1 * (g - m[j])
                    v[j] += 0.01 * (g * g - v[j])
                    params[j] -= (lr * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
                    mean[j] += max(0.005, 1 / step) * (params[j] - mean[j])
        for p, q in zip(params, mean, strict=True):
            p[...] = q

    def _forward(self, x: np.ndarray, scale: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = x.shape[1] - REACH
        r = self.conv[0][x[:, :n]]
        for k in range(1, REACH):
            r += self.conv[k][x[:, k : k + n]]
        arg = r.argmax(1)
        h = np.maximum(np.take_along_axis(r, arg[:, None], 1)[:, 0] + self.bias, 0)
        h = h if scale is None else h * scale
        z = h @ self.out + self.base
        z = np.exp(z - z.max(1, keepdims=True))
        return arg, h, z / z.sum(1, keepdims=True)


def _undecided() -> ByteCNN:
    """A network without training: every class is equally likely, so that no sentence is sure of one."""
    model = ByteCNN()
    model.out[:] = 0
    return model


def _window_matrix(s: Sentences) -> np.ndarray:
    out = np.zeros((len(s.starts), WINDOW + REACH), np.uint8)
    for i, (a, n) in enumerate(zip(s.starts, s.size, strict=True)):
        out[i, :n] = s.data[a : a + n]
    return out


def _grams(text: str) -> set[str]:
    """Words, and pairs of characters of words in scripts without blanks."""
    out = set()
    for w in _TOKEN.findall(_lower(text)):
        if w[0] in "#@0123456789":
            continue
        if w > "\u0e00" and not "\uac00" <= w[0] <= "\ud7a3":
            out.update(w[i : i + 2] for i in range(len(w) - 1))
        else:
            out.add(w)
    return out


class _WordVotes:
    """Naive Bayes over the rows of the sample, each label's rows weighing the same."""

    def __init__(self, texts: list[str], y: np.ndarray):
        rows_with = Counter(w for t in texts for w in _grams(t))
        self.index = {w: i for i, w in enumerate(w for w, n in rows_with.items() if n >= COMMON_ROWS)}
        del rows_with
        counts = np.full((len(self.index) + 1, len(LANGS)), 0.5)
        for t, c in zip(texts, y, strict=True):
            counts[[self.index[w] for w in _grams(t) if w in self.index], c] += 1
        self.score = np.log(counts / (np.bincount(y, minlength=len(LANGS)) + 1))

    def best(self, words: set[str]) -> int:
        at = [self.index[w] for w in words if w in self.index]
        return int(self.score[at].sum(0).argmax()) if at else -1


def train(texts: list[str], labels: list[str], per_class: int = 4000, seed: int = 11) -> ByteCNN:
    """A network from labelled texts; labels are of LANGS. Lists of tags train "no language" if there are any.

    Without a sentence to train on every class is equally likely, and no stretch comes out.
    """
    rng = np.random.default_rng(seed)
    model = ByteCNN()
    y = np.array([LANGS.index(c) for c in labels], np.int64)
    common = {w for w, n in Counter(w for t in texts for w in set(_TOKEN.findall(_lower(t)))).items() if n >= COMMON_ROWS}
    spoken = _WordVotes(texts, y)
    names: dict[int, list[str]] = {}
    for t, c in zip(texts, y, strict=True):
        names.setdefault(int(c), []).extend(w.strip("#@") for w in t.split() if w[0] in "#@")
    windows, target, title = [], [], []
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        s = cut(part)
        kind = np.full(len(s.row), -1)
        for i, (r, lo, hi) in enumerate(zip(s.row, s.begin, s.end, strict=True)):
            ws = [w for w in _TOKEN.findall(_lower(part[r])[lo:hi]) if w[0] not in "#@0123456789"]
            known = sum(w in common for w in ws)
            runs = [len(w) * (0.6 if w < "\u3000" else 1) for w in ws if w > "\u0e00"]  # Thai spells a name with more characters
            if known >= 3 or max(runs, default=0) >= 10:
                if spoken.best(_grams(part[r][lo:hi])) == y[at + r]:
                    kind[i] = y[at + r]
            elif not known and max(runs, default=0) <= 7:
                kind[i] = NONE
        windows.append(_window_matrix(s))
        target.append(kind[s.sentence])
        title.append(s.begin[s.sentence] == 0)
    lists = []
    for pool in map(np.array, names.values()):
        for _ in range(min(400, 20 * len(pool))):
            sep = (" & ", " / ", ", ", " + ", " ", " - ", "・")[rng.integers(7)]
            lists.append(sep.join(rng.choice(pool, rng.integers(1, 7))))
    if lists:
        z = cut(lists)
        windows.append(_window_matrix(z))
        target.append(np.full(len(z.starts), NONE))
        title.append(np.zeros(len(z.starts), bool))
    if not any((t >= 0).any() for t in target):
        return _undecided()
    x, target, title = np.concatenate(windows), np.concatenate(target), np.concatenate(title)
    # Titles are short and few against the sentences of descriptions: they are taken first, and twice.
    take = []
    for c in range(NONE + 1):
        heads = rng.permutation(np.flatnonzero((target == c) & title))[: per_class // 4]
        rest = rng.permutation(np.flatnonzero((target == c) & ~title))
        take += [heads, heads, rest[: per_class - 2 * len(heads)]]
    take = np.concatenate(take)
    model.fit(x[take], target[take])
    return model


def fit_on(df: DataFrame, label: Column, fields: list[str], key: str = "row_id", sample: int = SAMPLE) -> ByteCNN:
    """Train on at most `sample` labelled rows of each language, the first by hash of their key.

    The hashes alone are ranked; texts are read only of rows up to each language's last hash.
    """
    marked = df.select(label_code(label).alias("label"), F.xxhash64(key).alias("h"), *fields)
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h"))  # limited before the shuffle
    last = marked.where("label is not null").select("label", "h").withColumn("n", rank).where(F.col("n") <= sample).groupBy("label").agg(F.max("h").alias("h")).collect()
    if not last:
        return _undecided()
    wanted = F.lit(False)
    for r in last:  # a row per language
        wanted = wanted | ((F.col("label") == r.label) & (F.col("h") <= r.h))
    text = F.concat_ws("\n", *(present(f) for f in fields))
    rows = marked.where(wanted).select("label", "h", text.alias("text")).where("text <> ''").orderBy("label", "h", "text").limit(sample * len(LANGS)).collect()
    return _trained(df.sparkSession, [r.text for r in rows], [r.label for r in rows])


def _trained(spark: SparkSession, texts: list[str], labels: list[str]) -> ByteCNN:
    """A network from these texts; its weights lie in the shared folder under a key of the texts and of this module, so that they are fitted once."""
    material = [inspect.getsource(sys.modules[__name__]), *(f"{c}\0{t}" for c, t in zip(labels, texts, strict=True))]
    key = hashlib.sha256("\0".join(material).encode("utf-8", "surrogatepass")).hexdigest()
    path = f"{shared_dir(spark)}/siftline-languages/{key}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        model = ByteCNN()
        model.conv, model.bias, model.out, model.base = (np.frombuffer(r.data, np.float32).reshape(r.shape).copy() for r in spark.read.parquet(path).orderBy("i").collect())
        return model
    model = train(texts, labels)
    rows = [(i, list(w.shape), bytearray(w.astype(np.float32).tobytes())) for i, w in enumerate((model.conv, model.bias, model.out, model.base))]
    spark.createDataFrame(rows, "i int, shape array<int>, data binary").coalesce(1).write.mode("overwrite").parquet(path)
    return model


def _whole(p: np.ndarray, weight: np.ndarray, row: np.ndarray, texts: list) -> tuple[np.ndarray, ...]:
    """The parts of each text put together; parts without language count only where nothing else is."""
    rows = np.unique(row)
    at = np.searchsorted(rows, row)
    total = np.zeros((len(rows), NONE + 1))
    np.add.at(total, at, p * weight[:, None] * np.where(p.argmax(1) < NONE, 1, 1e-3)[:, None])
    return total / total.sum(1, keepdims=True), np.bincount(at, weights=weight, minlength=len(rows)), rows, np.zeros(len(rows), int), np.array([len(texts[i]) for i in rows], int)


def _detector(model: ByteCNN, fields: list[str]):
    from siftline.llm import units

    def detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in units.slices(batches, fields[-1], 400_000):
            n = len(b)
            ids, labels = b["row_id"].tolist(), b["label"].tolist()
            parts = []
            for f in fields:
                s = cut(b[f].tolist())
                p, weight, row, lo, hi, share = model.probabilities(s), s.sentence_sizes(), s.row, s.begin, s.end, s.share
                if f == "title":  # a title is one unit: its parts are judged together
                    p, weight, row, lo, hi = _whole(p, weight, row, b[f].tolist())
                    share = np.ones(len(row))
                parts.append((f, p, weight, row, lo, hi, share))
            main = np.zeros((n, NONE))
            for _, p, weight, row, _, _, _ in parts:
                np.add.at(main, row, p[:, :NONE] * weight[:, None])
            main = main.argmax(1)
            stretches: list[list[list]] = [[] for _ in range(n)]
            for f, p, _, row, los, his, share in parts:
                best = p.argmax(1)
                conf = p[np.arange(len(p)), best]
                sure = (best < NONE) & (conf >= np.where(best == main[row], MIN_MAIN, MIN_OTHER)) & ((best == main[row]) | (share >= MIN_SHARE))
                for i, lang, c, lo, hi in zip(row[sure].tolist(), best[sure].tolist(), conf[sure].tolist(), los[sure].tolist(), his[sure].tolist(), strict=True):
                    mine = stretches[i]
                    if mine and mine[-1][0] == f and mine[-1][3] == lang:
                        mine[-1][2], mine[-1][4], mine[-1][5] = hi, mine[-1][4] + c, mine[-1][5] + 1
                    else:
                        mine.append([f, lo, hi, lang, c, 1])
            out = []
            for i, mine in enumerate(stretches):
                used = sorted({LANGS[m[3]] for m in mine})
                seen = set()
                for f, lo, hi, lang, c, k in mine:
                    out.append((ids[i], f, lo, hi, LANGS[lang], c / k, (f, lang) not in seen, labels[i], used))
                    seen.add((f, lang))
            yield pd.DataFrame(out, columns=["row_id", "field_name", "stretch_start", "stretch_end", "lang", "confidence", "first", "label", "used"])

    return detect


def stretches(df: DataFrame, model: ByteCNN, label_col: str = "lang", fields: tuple[str, ...] = ("title", "description")) -> DataFrame:
    """STRETCHES: every stretch of a row's fields that is in one language, with a confidence from 0 to 1.

    Missing fields and texts of names, tags, times and links alone have no stretch. `used` holds all languages of
    the row, `first` marks one stretch per field and language, `label` is the declared language or null. Rows
    with a null row_id are left out; repeated rows come out repeatedly; other columns are ignored.
    """
    base = df.where("row_id is not null").select(F.col("row_id").cast("bigint").alias("row_id"), label_code(label_col).alias("label"), *(present(f).alias(f) for f in fields))
    return base.mapInPandas(_detector(model, list(fields)), STRETCHES)


def label_cases(found: DataFrame) -> DataFrame:
    """(row_id, field_name, lang) of rows with a missing or wrong label or with several languages."""
    case = F.col("label").isNull() | ~F.array_contains("used", F.col("label")) | (F.size("used") > 1)
    return found.where(case & F.col("first")).select("row_id", "field_name", "lang")
