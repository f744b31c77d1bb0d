"""Operator 7, benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders. Windows of the
resulting template are hashed and joined with the windows of the benchmark
items; a check of the slots keeps a match only if every value of the item
stands for one and the same value in the document. So copies and questions
with other numbers and names are found alike.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, OrderedDict, defaultdict
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 5                   # words of a window
SHARE = 0.8                  # share of an item's words that matched windows must cover
BLOCK_CHARS = 8 << 20        # characters of benchmark items that one pass over the documents takes
KEPT_TOKENS = 400_000
KEPT_ITEMS = 2_000           # templates of items that a worker remembers
SCAN_CHARS = 1 << 20         # characters of documents that are looked up at once
FILTER_BITS = 22             # bits of a hash that the first look uses
TEXT_PART = 1 << 20          # a long text is read in parts of about this many characters

# scripts without spaces: Thai, Lao, Tibetan, Burmese, Khmer, kana, Chinese characters
UNSPACED = ("\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
            "\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff")
# a number, a word (a character of a script without spaces), a sign before a number, or what ends a sentence
TOKEN = re.compile(rf"\d+(?:[.,:/]\d+)*|[^\W\d_{UNSPACED}]+|(?![\W\d_])[{UNSPACED}]|[-+*/^=<>\u00d7\u00f7\u2212](?=[ \t(]*\d)|[.!?\n]")
# fixed values: units of measure, currencies and time
UNITS = set("mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms pound "
            "pounds lb lbs oz ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds "
            "minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro "
            "euros percent degree degrees celsius fahrenheit kelvin meter meters metre metres kilometer kilometers "
            "kilometre kilometres hz khz mhz ghz w kw v a n j kj pa mph kmh usd eur gbp".split())
# fixed values: numbers in words
NUMBERS = set("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
              "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
              "million billion".split())

WORD, CAPITAL, NUMBER, UNIT, END, CAPITAL_UNIT = range(6)
SLOT = np.array([0, 0x1F123BB5159A55E5, 0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)   # placeholder hashes
P = 0x9E3779B97F4A7C15


class Tokens(dict):
    """Token -> its class and the 32-bit hash of its lower case in one number; forgets all when it has grown to a fixed size."""

    def __missing__(self, token: str) -> int:
        if len(self) >= KEPT_TOKENS:
            self.clear()
        low = token.lower()
        if token in ".!?\n":
            kind = END
        elif token[0].isdigit() or low in NUMBERS:
            kind = NUMBER
        elif token[0] != low[0]:
            kind = CAPITAL_UNIT if low in UNITS else CAPITAL
        else:
            kind = UNIT if low in UNITS else WORD
        out = kind << 33 | zlib.crc32(low.encode("utf-8", "surrogatepass")) + 1
        if len(token) <= 64:
            self[token] = out
        return out


KNOWN = Tokens()


class Stream:
    """Words of one text or of several behind each other: slot types and template hashes in three readings.

    A capital at the start of a sentence may be a name or any word: reading 0
    takes it as a word, reading 1 as a name. Reading 2 takes all names as words in lower
    case, so that a copy is found whatever its case.
    """

    def __init__(self, toks: list[str], sizes: list[int]):
        codes = np.fromiter(map(KNOWN.__getitem__, toks), np.int64, len(toks))
        kind, low = codes >> 33, (codes & ((1 << 33) - 1)).astype(np.uint64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        self.word = word = np.flatnonzero(kind != END)
        self.owner = owner[word]
        new = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
        first = (new | np.r_[False, kind[:-1] == END][:len(kind)])[word]
        k = kind[word]
        name = (k == CAPITAL) | (k == CAPITAL_UNIT)
        counted = np.r_[False, (k[:-1] == NUMBER) & (self.owner[1:] == self.owner[:-1])][:len(k)]
        unit = (k == UNIT) & counted
        self.literals = low[word] * np.uint64(0xD6E8FEB86659FD93)
        self.hashes, self.slots = [], []
        for names, units in ((name & ~first, unit), (name, unit), (name & False, unit | (k == CAPITAL_UNIT) & counted)):
            slot = np.where(k == NUMBER, 2, np.where(units, 3, np.where(names, 1, 0)))
            self.slots.append(slot)
            self.hashes.append(np.where(slot > 0, SLOT[slot], self.literals))

    def within(self, width: int) -> np.ndarray:
        """The places whose window of ``width`` words lies in one text."""
        n = max(len(self.word) - width + 1, 0)
        return np.flatnonzero(self.owner[:n] == self.owner[width - 1:width - 1 + n]) if n else np.zeros(0, np.int64)


class Template(Stream):
    """The stream of a single text, with its words."""

    def __init__(self, text: str):
        self.toks = TOKEN.findall(text)
        super().__init__(self.toks, [len(self.toks)])
        self.bares: dict[tuple[int, int], np.ndarray] = {}
        # reading 1 differs only where a capital starts a sentence
        self.second = bool((self.slots[0] != self.slots[1]).any())
        self.named = bool((self.slots[0] != self.slots[2]).any())

    def __len__(self):
        return len(self.word)

    def value(self, i: int) -> str:
        return self.toks[self.word[i]].lower()

    def windows(self, reading: int, width: int) -> np.ndarray:
        """The hash of the window at each word; empty if the text is shorter."""
        return self.rolled(self.hashes[reading], width)

    @staticmethod
    def rolled(h: np.ndarray, width: int) -> np.ndarray:
        n = len(h) - width + 1
        out = np.zeros(max(n, 0), np.uint64)
        for j in range(width):
            out = out * np.uint64(P) + h[j:j + n] if n > 0 else out
        return out ^ (out >> np.uint64(29))

    def readings(self, width: int):
        """(reading, windows to look at): all of reading 0, of readings 1 and 2 those that differ from it."""
        every = np.arange(max(len(self) - width + 1, 0))
        yield 0, every
        for r, differs in ((1, self.second), (2, self.named)):
            if differs and len(every):
                other, some = self.slots[0] != self.slots[r], np.zeros(len(every), bool)
                for j in range(width):
                    some |= other[j:j + len(every)]
                yield r, np.flatnonzero(some)

    def literal(self, reading: int, width: int) -> np.ndarray:
        """Words of each window that are not slots."""
        n = len(self) - width + 1
        c = np.cumsum(np.r_[0, self.slots[reading] == 0])
        return c[width:] - c[:-width] if n > 0 else np.zeros(0, np.int64)

    def bare(self, reading: int, width: int) -> np.ndarray:
        """The windows of placeholders alone, if others hold words; the benchmark's hashes leave them out."""
        if (reading, width) not in self.bares:
            lit = self.literal(reading, width)
            self.bares[reading, width] = np.flatnonzero(lit == 0) if (lit > 0).any() else np.zeros(0, np.int64)
        return self.bares[reading, width]


class Benchmark:
    """The items of one block: their texts and their window hashes, sorted by hash and by item."""

    def __init__(self, items: list[tuple[int, str]], width: int):
        self.width, self.ids, self.texts = width, [i for i, _ in items], [t for _, t in items]
        self.kept: OrderedDict[int, Template] = OrderedDict()
        hashes, item, pos, reading = [], [], [], []
        self.short: dict[int, dict[int, list[int]]] = defaultdict(dict)      # words, hash of all words -> items
        self.size, self.bares = np.zeros(len(items), np.int32), np.zeros(len(items), np.int32)
        for n, text in enumerate(self.texts):
            t = Template(text)
            self.size[n] = len(t)
            if 0 < len(t) < width:
                self.short[len(t)].setdefault(int(t.rolled(t.literals, len(t))[0]), []).append(n)
            bare = set()
            for r, at in t.readings(width):
                if r == 1:      # all windows, so that those alike in readings 0 and 1 count twice in the vote on slot values
                    at = np.arange(len(t) - width + 1)
                # windows of placeholders alone would match anything; an item of nothing else keeps them
                lit = t.literal(r, width)
                at = at[lit[at] > 0] if (lit > 0).any() else at
                bare.update(t.bare(r, width).tolist())
                hashes.append(t.windows(r, width)[at])
                item.append(np.full(len(at), n, np.int32))
                pos.append(at.astype(np.int32))
                reading.append(np.full(len(at), r, np.int8))
            self.bares[n] = len(bare)
        cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        self.hash, self.item = cat(hashes, np.uint64), cat(item, np.int32)           # by item
        self.pos, self.reading = cat(pos, np.int32), cat(reading, np.int8)
        self.starts = np.searchsorted(self.item, np.arange(len(items) + 1))
        self.order = np.argsort(self.hash, kind="stable").astype(np.int32)
        self.sorted = self.hash[self.order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._bucket(self.hash)] = True
        self.whole = {n: np.array(sorted(known), np.uint64) for n, known in self.short.items()}

    @staticmethod
    def _bucket(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def template(self, n: int) -> Template:
        if n in self.kept:
            self.kept.move_to_end(n)
        else:
            if len(self.kept) >= KEPT_ITEMS:
                self.kept.popitem(last=False)
            self.kept[n] = Template(self.texts[n])
        return self.kept[n]

    def known(self, h: np.ndarray) -> np.ndarray:
        """Which of the window hashes the block has."""
        out = self.filter[self._bucket(h)]
        some = np.flatnonzero(out)
        lo = np.searchsorted(self.sorted, h[some])
        out[some] = self.sorted[np.minimum(lo, len(self.sorted) - 1)] == h[some]
        return out

    def scan(self, texts: list[str]) -> list[int]:
        """The texts that share a window with an item or may hold a short one, looked up as one stream of words."""
        toks = list(map(TOKEN.findall, texts))
        stream = Stream(list(chain.from_iterable(toks)), list(map(len, toks)))
        found = [np.zeros(0, np.int64)]
        inside = stream.within(self.width)
        if len(inside) and len(self.hash):
            for r in range(3):
                at = inside
                if r:                                       # windows that differ from reading 0
                    other = np.cumsum(np.r_[0, stream.slots[r] != stream.slots[0]])
                    at = inside[other[inside + self.width] > other[inside]]
                h = Template.rolled(stream.hashes[r], self.width)[at]
                found.append(stream.owner[at[self.known(h)]])
        for n, hashes in self.whole.items():
            at = stream.within(n)
            found.append(stream.owner[at[np.isin(Template.rolled(stream.literals, n)[at], hashes)]])
        return np.unique(np.concatenate(found)).tolist()

    def search(self, texts: list[str], share: float):
        """(number of the text, item id, windows matched, share of words covered, slots that changed), text by text."""
        own, some, have = [], [], 0

        def flush():
            for k in self.scan(some):
                for m in self._matches(Template(some[k]), share):
                    yield own[k], *m
        for n, text in enumerate(texts):
            for part in parts(text):
                own.append(n)
                some.append(part)
                have += len(part)
                if have >= SCAN_CHARS:
                    yield from flush()
                    own, some, have = [], [], 0
        yield from flush()

    def _along(self, doc: Template, item: Template, found: set) -> set:
        """Windows of placeholders alone that stand at the shift of a matched window, with the slot types of the item."""
        more = set()
        for r in (0, *[1] * item.second, *[2] * item.named):
            at = item.bare(r, self.width)
            if not len(at):
                continue
            want = item.slots[r][at[:, None] + np.arange(self.width)]
            for shift in {p - b for p, b, _ in found}:
                in_doc = (at + shift >= 0) & (at + shift + self.width <= len(doc))
                places = (at[in_doc] + shift)[:, None] + np.arange(self.width)
                same = np.zeros(len(places), bool)
                for slots in doc.slots:
                    same |= (slots[places] == want[in_doc]).all(axis=1)
                more |= {(b + shift, b, r) for b in at[in_doc][same].tolist()}
        return found | more

    def matches(self, text: str, share: float):
        """(item id, windows matched, share of the item's words covered, slots that changed) of contained items."""
        for _, *m in self.search([text], share):
            yield tuple(m)

    def _whole(self, doc: Template):
        """Items of fewer words than a window: all their words, numbers and names too, stand in the text one after the other."""
        for n, known in self.short.items():
            h = doc.rolled(doc.literals, n)
            found = set()
            for p in np.flatnonzero(np.isin(h, np.fromiter(known, np.uint64, len(known)))).tolist():
                found.update(i for i in known[int(h[p])] if i not in found
                             and all(self.template(i).value(j) == doc.value(p + j) for j in range(n)))
            for i in sorted(found):
                yield self.ids[i], 1, 1.0, 0

    def _matches(self, doc: Template, share: float):
        yield from self._whole(doc)
        places, hashes = [], []
        for r, look in doc.readings(self.width):
            if not len(look) or not len(self.hash):
                break
            h = doc.windows(r, self.width)[look]
            hit = self.known(h)
            places.append(look[hit])
            hashes.append(h[hit])
        if not places:
            return
        places, hashes = np.concatenate(places), np.concatenate(hashes)
        order = np.argsort(hashes, kind="stable")
        places, hashes = places[order], hashes[order]
        for i in self._covered(np.unique(hashes), share):
            item, own = self.template(i), slice(self.starts[i], self.starts[i + 1])
            lo, hi = np.searchsorted(hashes, self.hash[own]), np.searchsorted(hashes, self.hash[own], side="right")
            n = hi - lo
            at = places[np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())]
            found = set(zip(at.tolist(), np.repeat(self.pos[own], n).tolist(), np.repeat(self.reading[own], n).tolist()))
            found = self._along(doc, item, found)
            if len({b for _, b, _ in found}) + self.width - 1 < share * len(item):
                continue
            best = self._consistent(doc, item, found)
            if best[1] >= share:
                yield (self.ids[i], *best)

    def _covered(self, hashes: np.ndarray, share: float) -> list[int]:
        """The items of which enough different windows are among ``hashes``, however often these occur in the text.

        A window that many items share counts once for each of them; the places of a window are only looked at for the items left.
        """
        lo, hi = np.searchsorted(self.sorted, hashes), np.searchsorted(self.sorted, hashes, side="right")
        n = hi - lo
        at = self.order[np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())]
        pair = np.unique(self.item[at].astype(np.int64) << 32 | self.pos[at])
        items, windows = np.unique(pair >> 32, return_counts=True)
        enough = windows + self.bares[items] + self.width - 1 >= share * self.size[items]
        return items[enough].tolist()

    def _consistent(self, doc: Template, item: Template, found: set) -> tuple[int, float, int]:
        """Coverage by matches near one place whose slot values agree with each other."""
        best = (0, 0.0, 0)
        found = sorted(found, key=lambda x: (x[0] - x[1], x[1]))
        # copies of the item in a text lie at different shifts; edits move the shift a little
        reach, start = max(self.width, len(item) // 4), 0
        while start < len(found):
            stop = start + 1
            while stop < len(found) and found[stop][0] - found[stop][1] <= found[start][0] - found[start][1] + reach:
                stop += 1
            best = max(best, self._one(doc, item, found[start:stop]), key=lambda x: (x[1], x[0]))
            shift = found[start][0] - found[start][1]
            while start < len(found) and found[start][0] - found[start][1] == shift:
                start += 1
        return best

    def _one(self, doc, item, found):
        votes: dict[str, Counter] = defaultdict(Counter)
        slots = {}
        for p, b, r in found:
            slots[p, b, r] = [(f"{s}{item.value(b + j)}", doc.value(p + j))
                              for j, s in enumerate(item.slots[r][b:b + self.width].tolist()) if s]
            for x, y in slots[p, b, r]:
                votes[x][y] += 1
        # one document value for each item value, and no document value for two
        means, used = {}, {}
        for x, y, n in sorted(((x, y, n) for x, c in votes.items() for y, n in c.items()), key=lambda v: (-v[2], v[0], v[1])):
            if x not in means and (x[0], y) not in used:
                means[x] = y
                used[x[0], y] = x
        good = [k for k in found if all(means.get(x) == y for x, y in slots[k])]
        covered = {b + j for _, b, _ in good for j in range(self.width)}
        return len({b for _, b, _ in good}), len(covered) / len(item), sum(x[1:] != y for x, y in means.items())


def parts(text: str):
    """Parts of a long text that overlap, so that no item of up to a part's half is cut in both."""
    if len(text) <= 2 * TEXT_PART:
        yield text
        return
    for at in range(0, len(text) - TEXT_PART, TEXT_PART):
        yield text[at:at + 2 * TEXT_PART]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = WINDOW, share: float = SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item it contains: ``doc_id, item_id, n_windows, coverage, n_changed``.

    ``coverage`` is the share of the item's words inside matched windows of
    ``width`` words whose slots are consistent; rows reach ``share``.
    ``n_changed`` counts the item's slot values that the document replaces. An
    item of fewer than ``width`` words is one window and matches only the same words
    (in any case) and numbers; an item without words and null texts match nothing. In scripts
    without spaces each character is a word. Rows with equal ids are judged one by one and give one
    row with the best coverage. The documents are read once for every
    ``block_chars`` characters of benchmark text (one broadcast of that size
    each); there is no pair of documents.
    """
    found = None
    for block in blocks(benchmark, width, block_chars):
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        one = rows.where("text is not null").mapInArrow(
            _finder(docs.sparkSession.sparkContext.broadcast(block), share),
            "doc_id long, item_id long, n_windows long, coverage double, n_changed long")
        found = one if found is None else found.union(one)
    best = F.max(F.struct("coverage", "n_windows", (-F.col("n_changed")).alias("same"))).alias("best")
    return (found.groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", F.col("best.n_windows").alias("n_windows"),
                    F.col("best.coverage").alias("coverage"), (-F.col("best.same")).alias("n_changed")))


def blocks(benchmark: DataFrame, width: int, block_chars: int):
    """The benchmark in blocks of bounded size, dealt by a hash of the item; at least one, which may be empty."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-2 * total // block_chars)) if total > block_chars else 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield Benchmark(sorted((r["item_id"], r["text"]) for r in part.toLocalIterator()), width)


def _finder(shared, share):
    def run(batches):
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            out = [(ids[k], *m) for k, *m in shared.value.search(b.column("text").to_pylist(), share)]
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()))],
                ["doc_id", "item_id", "n_windows", "coverage", "n_changed"])
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that contain no item, with their columns as they are.

    Each row is judged by its own text, whatever its id, in the pass that reads it.
    """
    keep = None
    for block in blocks(benchmark, width, BLOCK_CHARS):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        clean = _clean_udf(shared, share)(F.coalesce(F.col("text").cast("string"), F.lit("")))
        keep = clean if keep is None else keep & clean
    return docs.where(keep)


def _clean_udf(shared, share):
    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        found = {k for k, *_ in shared.value.search(text.tolist(), share)}
        return pd.Series([k not in found for k in range(len(text))], dtype=bool)

    return clean
