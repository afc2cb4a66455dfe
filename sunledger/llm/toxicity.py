"""Toxicity by the nearest labelled examples, under exact TF-IDF cosine, found in a block-max inverted index.

Terms are words and their beginnings (:data:`PREFIXES`), which carry what inflected insults have in common; every word of
every text counts. A term weighs ``log(1 + count)`` times its idf times its relevance frequency, ``log2(2 + r)`` where r is
how many times more common it is in examples of label 1: terms that go with the label weigh more, and none weighs
nothing. A term that no example holds cannot match, but it lengthens its text's vector.

Examples are a bounded sample of the labelled rows (:data:`EXAMPLES`, :data:`EXAMPLE_BYTES`), and idf and relevance are
fitted on them. Examples that lie close together share a block. The lists of rarer terms are short and added up; the long
lists of common terms, which are most of the work, lie by block, with the largest weight of each term and block. What the
rarer terms gave, and these maxima, bound a text's cosine to all examples of a block at once. What the rarer terms gave in
the blocks with the largest bounds, and at best in each block, is less than the cosines there; blocks whose bound is under the
k-th best of it are skipped: no neighbour is missed. A batch of texts meets a block in one product, in single precision, whose error is bounded: what may be among the
nearest by that is added up again in double precision. In a list the examples with the same count of the term lie
together: it holds their places, two bytes each, and one weight a run, and the examples' lengths divide the sums.

Neighbours vote with weights that fall with distance, each class by its share among the examples, so that few positives
are not outvoted by their number. An example with the very text that is scored is left out, once, for texts that were
learned from and others alike. Votes become probabilities by isotonic regression over the examples' own votes.

One task counts the bounded sample and lays the lists. They pass through the driver as one packed value, a few bytes a term
and posting, on their way to the workers.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.llm.common import crc_mod, in_use, kept, own_names, private, release, run_dir, stored

#: Labelled rows of each class that become examples, and bytes of their texts in all.
EXAMPLES = 4000
EXAMPLE_BYTES = 32 << 20
PREFIXES = (4, 5, 6, 7, 8)
#: Numbers of neighbours to choose from, by the examples' own votes.
NEIGHBOURS = (3, 5, 9, 15)
#: A vote weighs by this power of the distance's inverse.
POWER = 3
#: Examples of a block, and blocks of a group. A term that more than one in so many examples hold is common.
BLOCK = 32
GROUP = 8
COMMON = 16
#: Texts searched together.
BATCH = 128
THRESHOLD = 0.7
#: Words whose terms a worker remembers.
REMEMBERED = 100_000

WORD = re.compile(r"[^\W\d_]+")
#: Spaces for all of Latin-1 that is in no word.
SPACED = bytes(c if WORD.match(chr(c)) else 32 for c in range(256))


# --- terms ---


def words_of(text: str | None) -> list[str]:
    """All words in lower case."""
    text = (text or "").lower()
    try:
        return text.encode("latin-1").translate(SPACED).decode("latin-1").split()
    except UnicodeEncodeError:
        return WORD.findall(text)


def word_terms(word: str) -> list[str]:
    """A word's terms: itself and its beginnings."""
    return [word, *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)]


#: How the beginnings of a word are cut, by its length; their hashes differ from those of words by some bits.
CUTS = [tuple(slice(k) for k in PREFIXES if length > k) for length in range(PREFIXES[-1] + 2)]
BEGINNING = 0x5BD1E995_9E3779B9


class Terms:
    """The numbers of each word's terms, remembered as long as there is room. Terms of the vocabulary have their place
    in it; others get numbers beyond, by a 48-bit hash that this process alone knows. The vocabulary is held as its hashes,
    of 64 bits, and the numbers lie in one array: a tenth of what strings and lists would take."""

    def __init__(self, vocabulary: Iterable[str]):
        hashes = np.fromiter((hash(t[1:]) ^ BEGINNING if t[0] == "^" else hash(t) for t in vocabulary), np.int64)
        self.size, self.place = len(hashes), np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.place]
        #: Where each remembered word's numbers start, and one more; the numbers, with room behind them.
        self.words: dict[str, int] = {}
        self.start = np.zeros(REMEMBERED + 1, np.int64)
        self.numbers = np.zeros(1024, np.int64)

    def numbers_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The terms of all words, one after the other, and how many each word has."""
        sizes = 1 + np.searchsorted(PREFIXES, np.fromiter(map(len, words), np.int64, len(words)))
        cut = ((w, *map(w.__getitem__, CUTS[min(len(w), len(CUTS) - 1)])) for w in words)
        found = np.fromiter(map(hash, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        whole = np.cumsum(sizes) - sizes
        hashes = found ^ BEGINNING
        hashes[whole] = found[whole]
        numbers = self.size + (hashes & 0xFFFFFFFFFFFF)
        if self.size:
            # In order, so that one search begins where the one before has been.
            order = np.argsort(hashes)
            hashes = hashes[order]
            at = np.minimum(np.searchsorted(self.hashes, hashes), self.size - 1)
            inside = self.hashes[at] == hashes
            numbers[order[inside]] = self.place[at[inside]]
        return numbers, sizes

    def remember(self, words: list[str]) -> None:
        """Different words that are not remembered yet, as far as there is room."""
        first = len(self.words)
        words = words[: len(self.start) - 1 - first]
        numbers, sizes = self.numbers_of(words)
        ends = self.start[first] + np.cumsum(sizes)
        more = int(ends[-1]) - len(self.numbers) if len(words) else 0
        if more > 0:
            self.numbers = np.concatenate([self.numbers, np.zeros(max(len(self.numbers), more), np.int64)])
        self.numbers[self.start[first] : self.start[first] + len(numbers)] = numbers
        self.start[first + 1 : first + 1 + len(words)] = ends
        self.words.update(zip(words, range(first, first + len(words))))

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray, float]:
        """Terms of the vocabulary in order and how often each occurs, and the squares of ``log(1 + count)`` of all
        others, added up."""
        return next(self.counts_of([text]))

    def counts_of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """The same for each of some texts, whose words are looked up together."""
        words = [Counter(words_of(text)) for text in texts]
        at, unknown = self._look_up(words)
        if unknown and len(self.words) < len(self.start) - 1:
            self.remember(list(dict.fromkeys(unknown)))
            at, unknown = self._look_up(words)
        often = np.fromiter(chain.from_iterable(w.values() for w in words), np.int64, len(at))
        text = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        known = at >= 0
        first = self.start[at[known]]
        sizes = self.start[at[known] + 1] - first
        parts = [self._parts(self.numbers[ranges(first, sizes)], sizes, often[known], text[known], len(words))]
        if unknown:
            parts.append(self._parts(*self.numbers_of(unknown), often[~known], text[~known], len(words)))
        for i in range(len(words)):
            number, times = (np.concatenate([of[j][edge[i] : edge[i + 1]] for *of, edge in parts]) for j in (0, 1))
            order = np.argsort(number)
            number, times = number[order], times[order]
            if len(number):
                first = np.concatenate([[0], np.flatnonzero(number[1:] != number[:-1]) + 1])
                number, times = number[first], np.add.reduceat(times, first)
            inside = int(np.searchsorted(number, self.size))
            yield number[:inside], times[:inside], float((np.log1p(times[inside:]) ** 2).sum())

    def _look_up(self, words: list[Counter[str]]) -> tuple[np.ndarray, list[str]]:
        """Which remembered word each word of each text is, -1 for none; and those that are none."""
        at = np.fromiter(map(self.words.get, chain.from_iterable(words), repeat(-1)), np.int64, sum(map(len, words)))
        return at, list(compress(chain.from_iterable(words), at < 0))

    def _parts(self, numbers: np.ndarray, sizes: np.ndarray, often: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, ...]:
        """Terms of words, how often they occur, and where those of each text begin."""
        edges = np.append(0, np.cumsum(sizes))[np.searchsorted(text, np.arange(texts + 1))]
        return numbers, np.repeat(often, sizes), edges


# --- index ---


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start, start + 1, ..`` of each range, one after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def slices(n: int, size: int = 1 << 19) -> Iterator[slice]:
    """Parts of so many entries, for work that would take many bytes for each."""
    return (slice(at, min(at + size, n)) for at in range(0, n, size))


def places(of: np.ndarray) -> np.ndarray:
    """The place of each example."""
    out = np.empty(len(of), np.int32)
    out[of] = np.arange(len(of), dtype=np.int32)
    return out


def close_together(points: np.ndarray, most: int) -> np.ndarray:
    """An order of points in which neighbours are near: halves along the longest axis, and so on."""
    out: list[np.ndarray] = []
    todo = [np.arange(len(points))]
    while todo:
        some = todo.pop()
        if len(some) <= most:
            out.append(some)
            continue
        centred = points[some] - points[some].mean(axis=0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        some = some[np.argsort(centred @ axis, kind="stable")]
        # Halves of whole blocks, so that all but the last are full.
        half = -(-len(some) // (2 * most)) * most
        todo += [some[half:], some[:half]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def neighbourly(example: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, terms: int, block: int) -> np.ndarray:
    """An order in which examples that lie close together share a block, by a projection to a few dimensions."""
    rng = np.random.default_rng(7)
    points = np.zeros((n, 32))
    for dim in range(32):
        direction = rng.standard_normal(terms, np.float32)
        for some in slices(len(term)):
            points[:, dim] += np.bincount(example[some], weight[some] * direction[term[some]], minlength=n)
    return close_together(points, block)


@dataclass
class Lists:
    """The examples that hold a term, term by term, in runs of the same weight and in order of place."""

    #: Runs of each term; per run its weight and how many examples it has.
    runs: np.ndarray
    weight: np.ndarray
    held: np.ndarray
    #: Place of each example of each run.
    place: np.ndarray

    @classmethod
    def laid(cls, term: np.ndarray, weight: np.ndarray, place: np.ndarray, terms: int) -> Lists:
        """From one entry per example and term."""
        parts = []
        for lo in range(0, max(terms, 1), 1 << 16):
            some = np.flatnonzero((term >= lo) & (term < lo + (1 << 16)))
            some = some[np.lexsort((place[some], weight[some], term[some]))]
            t, w = term[some] - lo, weight[some]
            first = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (w[1:] != w[:-1]))[: len(t)])
            runs = np.bincount(t[first], minlength=min(terms - lo, 1 << 16)).astype(np.uint32)
            parts.append((runs, w[first], np.diff(first, append=len(t)).astype(np.uint32), place[some]))
        return cls(*map(np.concatenate, zip(*parts)))

    def split(self, dense: np.ndarray) -> tuple[Lists, Lists]:
        """Those of some terms, and of all others; every term keeps its number."""
        run = np.repeat(dense, self.runs)
        entry = np.repeat(run, self.held)
        return tuple(
            Lists(np.where(d, self.runs, 0), self.weight[r], self.held[r], self.place[e])
            for d, r, e in ((dense, run, entry), (~dense, ~run, ~entry))
        )

    def sizes(self) -> np.ndarray:
        """How many examples hold each term."""
        ends = np.append(0, np.cumsum(self.held, dtype=np.int64))
        return np.diff(ends[np.append(0, np.cumsum(self.runs, dtype=np.int64))])


class Index:
    """Block-max inverted index over vectors, given by one entry per example and term and, where they are not one, by
    lengths that the entries are divided by."""

    def __init__(
        self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, terms: int, block: int = BLOCK, of: np.ndarray | None = None
    ):
        of = neighbourly(example, term, weight, n, terms, block) if of is None else of
        self._lay(Lists.laid(term, weight, places(of)[example], terms), of, np.ones(n), block)

    @classmethod
    def of_lists(cls, lists: Lists, of: np.ndarray, length: np.ndarray, block: int = BLOCK) -> Index:
        index = cls.__new__(cls)
        index._lay(lists, of, length, block)
        return index

    def _lay(self, lists: Lists, of: np.ndarray, length: np.ndarray, block: int) -> None:
        #: Which example lies at each place.
        self.of, self.n, self.block, self.blocks = of, len(of), block, -(-len(of) // block)
        self.share = 1 / length[of]
        # Terms that many examples hold lie in a dense table beside the lists, group by group.
        common = lists.sizes() * COMMON > self.n
        self.row = np.full(len(common), -1, np.int32)
        self.row[common] = np.arange(common.sum())
        dense, rare = lists.split(common)
        place, row = dense.place.astype(np.int64), np.repeat(np.arange(common.sum()), dense.sizes()[common])
        values, value = np.unique(dense.weight, return_inverse=True)
        value = np.repeat(value, dense.held)
        wide = GROUP * block
        self.dense = np.zeros((-(-self.n // wide), int(common.sum()), wide), np.float32)
        self.dense[place // wide, row, place % wide] = values[value] * self.share[place]
        #: Most that a sum of these products can be off, as a share of it: roundings of both factors, the product and each step.
        self.off = (int(common.sum()) + 8) * 2.0**-24
        self.dense_largest = np.zeros((int(common.sum()), self.blocks))
        np.maximum.at(self.dense_largest, (row, place // block), values[value] * self.share[place])
        # The same place by place, in full precision: the row and which of the values.
        order = np.argsort(place, kind="stable")
        self.values, self.of_row = values, row[order].astype(np.min_scalar_type(max(int(common.sum()) - 1, 0)))
        self.value = value[order].astype(np.min_scalar_type(max(len(values) - 1, 0)))
        self.entries = np.append(0, np.cumsum(np.bincount(place, minlength=self.n)))
        del order, value, row
        # The lists of the rarer terms: the places as bytes, which are copied list by list, and the runs.
        place = rare.place.astype(np.min_scalar_type(max(self.n - 1, 0)))
        starts = np.append(0, np.cumsum(rare.sizes() * place.itemsize))
        self.kind, self.weight, self.held = place.dtype, rare.weight, rare.held
        self.runs = np.append(0, np.cumsum(rare.runs, dtype=np.int64))
        self.lists = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(common), [None, pa.py_buffer(starts), pa.py_buffer(place)])
        self.edges = np.arange(0, self.n, block)

    def _rarer(self, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the rarer terms add to the cosine with the example of each place, times its length."""
        data = self.lists.take(pa.array(terms)).buffers()[2]
        first = self.runs[terms]
        runs = self.runs[terms + 1] - first
        run = ranges(first, runs)
        held, added = self.held[run], np.repeat(weight, runs) * self.weight[run]
        place = np.frombuffer(data, self.kind, int(held.sum())) if len(run) else np.zeros(0, self.kind)
        out = np.zeros(self.n)
        np.add.at(out, place.astype(np.intp), np.repeat(added, held))
        return out

    def _commoner(self, asked: np.ndarray, place: np.ndarray) -> np.ndarray:
        """What the common terms add to the cosine of a vector with the examples of some places, in full precision."""
        first = self.entries[place]
        held = self.entries[place + 1] - first
        entry = ranges(first, held)
        products = asked.take(self.of_row.take(entry))
        products *= self.values.take(self.value.take(entry))
        return np.bincount(np.repeat(np.arange(len(place)), held), products, minlength=len(place)) * self.share[place]

    def nearest(self, terms: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest cosine, ties by their number, and the cosines."""
        return self.nearest_of([(terms, weight)], k)[0][0]

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """The same for a batch of vectors, and how many examples were scored for all of them."""
        none = (np.zeros(0, np.int64), np.zeros(0))
        if not self.n:
            return [none] * len(vectors), 0
        asked = np.zeros((len(vectors), len(self.dense_largest)))
        scores = np.empty((len(vectors), self.n))
        for row, (terms, weight) in enumerate(vectors):
            at = self.row[terms]
            asked[row, at[at >= 0]] = weight[at >= 0]
            np.multiply(self._rarer(terms, weight), self.share, out=scores[row])
        # What the rarer terms add is known; the common ones add at most the sum of their largest weights in the block.
        best = np.maximum.reduceat(scores, self.edges, axis=1)
        bound = best + asked @ self.dense_largest
        # What the rarer terms gave in the block with the best bound, or one place of each block, tells which blocks can be skipped.
        few = min(self.blocks, -(-k // self.block) + 1)
        at = np.argpartition(-bound, few - 1, axis=1)[:, :few, None] * self.block + np.arange(self.block)
        at = at.reshape(len(vectors), -1)
        known = np.where(at < self.n, np.take_along_axis(scores, np.minimum(at, self.n - 1), axis=1), -1.0)
        least = self._least(np.maximum(self._kth(known, k), self._kth(best, k)))[:, None]
        chosen = bound >= least
        rough = self._score(scores, asked.astype(np.float32), chosen)
        scored = np.repeat(chosen, self.block, axis=1)[:, : self.n]
        near, out = scored & (rough >= least), []
        for row, (terms, _) in enumerate(vectors):
            # Those that may be among the nearest, by what all scored ones tell.
            at = np.flatnonzero(near[row])
            if len(at) > k:
                some = rough[row, at]
                at = at[some >= self._least(np.partition(some, len(at) - k)[len(at) - k])]
            # To twelve places, so that equal cosines compare equal.
            cosine = np.round(scores[row, at] + self._commoner(asked[row], at), 12)
            order = np.lexsort((self.of[at], -cosine))[:k]
            out.append((self.of[at[order]], cosine[order]) if len(terms) else none)
        return out, int(scored.sum())

    def _least(self, kth: np.ndarray) -> np.ndarray:
        """The least rough cosine, or bound, that an example can have that is no farther than k examples with these."""
        return kth * (1 - 2 * self.off) - 1e-9

    def _kth(self, scores: np.ndarray, k: int) -> np.ndarray:
        """The k-th best score of each row, -1 where there are fewer."""
        n = scores.shape[1]
        return np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(scores), -1.0)

    def _score(self, scores: np.ndarray, asked: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """The cosines of each vector with the examples of its chosen blocks, in single precision; where most blocks of a
        group are chosen, with the whole group, in one product."""
        rough = np.zeros(scores.shape, np.float32)
        for group, dense in enumerate(self.dense):
            some = chosen[:, group * GROUP : (group + 1) * GROUP]
            start = group * GROUP * self.block
            if 2 * np.count_nonzero(some) > some.size:
                here = slice(start, min(start + dense.shape[1], self.n))
                rough[:, here] = scores[:, here] + asked @ dense[:, : here.stop - start]
                continue
            for at in np.flatnonzero(some.any(axis=0)) * self.block:
                rows = np.flatnonzero(some[:, at // self.block])
                here = slice(start + at, min(start + at + self.block, self.n))
                rough[rows, here] = scores[rows, here] + asked[rows] @ dense[:, at : at + here.stop - here.start]
        return rough


# --- model ---


@dataclass
class Examples:
    """What is learned from, as counts: all that travels. The rest of the model follows from it."""

    #: Terms, some thousands of them to a string, and what each weighs: idf times relevance frequency.
    vocabulary: list[str]
    scale: np.ndarray
    #: How often each example holds each term, by runs of the same count.
    lists: Lists
    #: Which example lies at each place, and the length of each example's vector over the logarithms of its counts.
    of: np.ndarray
    length: np.ndarray
    doc_ids: np.ndarray
    labels: np.ndarray
    #: Labelled rows that an example stands for, so that the sampled classes keep their shares.
    stands_for: np.ndarray
    #: Hash of each example's text.
    texts: np.ndarray
    prior: float

    def packed(self) -> bytes:
        return zlib.compress(pickle.dumps(self), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Examples:
        return pickle.loads(zlib.decompress(data))

    def index(self) -> Index:
        counts = self.lists
        return Index.of_lists(Lists(counts.runs, np.log1p(counts.weight, dtype=float), counts.held, counts.place), self.of, self.length)


class Model:
    """Examples, the weight of each term, and the index; how votes are counted and calibrated is set later."""

    def __init__(self, examples: Examples):
        self.doc_ids, self.labels, self.stands_for = examples.doc_ids, examples.labels, examples.stands_for
        self.prior, n = examples.prior, len(examples.labels)
        held = np.bincount(self.labels.astype(int), minlength=2)
        self.scale = examples.scale
        #: Weight of a term that no example holds.
        self.other = float(np.log(1 + n) + 1)
        self.index = examples.index()
        self.terms = Terms(chain.from_iterable(part.split("\n") for part in examples.vocabulary))
        #: What each example's vote weighs: all examples of a class together weigh one.
        self.balance = 1 / np.maximum(held, 1)
        self.same_text: dict[int, list[int]] = {}
        for i, text in enumerate(examples.texts.tolist()):
            self.same_text.setdefault(text, []).append(i)
        self.k, self.knots = NEIGHBOURS[-1], (np.zeros(0), np.zeros(0))

    def vectors(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights, over the length of the whole vector, terms that no example holds included; each once more
        times what the term weighs, which the lists are without."""
        for terms, counts, others in self.terms.counts_of(texts):
            scale = self.scale[terms]
            weight = np.log1p(counts) * scale
            yield terms, weight * scale / (weight @ weight + others * self.other**2) ** 0.5 if len(terms) else weight

    def neighbours(self, texts: list[str | None], k: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text the nearest examples and their cosines, without one that has this very text."""
        k = k or self.k
        for at in range(0, len(texts), BATCH):
            some = texts[at : at + BATCH]
            for text, (found, cosine) in zip(some, self.index.nearest_of(list(self.vectors(some)), k + 1)[0]):
                others = found != self.same_text.get(text_hash(text), [-1])[0]
                yield found[others][:k], cosine[others][:k]

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> float:
        label = self.labels[found]
        weight = self.balance[label.astype(int)] / (1.01 - np.minimum(np.maximum(cosine, 0), 1)) ** POWER
        return float((weight * label).sum() / weight.sum()) if len(found) else self.prior

    def score(self, texts: list[str | None]) -> Iterator[tuple[float, np.ndarray]]:
        """For each text its probability, and the nearest examples as evidence. Without neighbours it is the labels' own
        share."""
        for found, cosine in self.neighbours(texts):
            vote = self.vote(found, cosine)
            known = len(found) and len(self.knots[0])
            yield (min(max(float(np.interp(vote, *self.knots)), 0.0), 1.0) if known else self.prior), self.doc_ids[found]


def text_hash(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) >> 1


def relevance(with_0: np.ndarray, with_1: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """Relevance frequency of each term, from how many examples of each label hold it. A term that no example of label 0
    holds counts as held by one."""
    return np.log2(2 + (with_1 / max(n1, 1)) / (np.maximum(with_0, 1) / max(n0, 1)))


def isotonic(votes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising curve from vote to share of label 1. One half of a row of either
    label is added to each pool, so that no score claims certainty."""
    pools: list[list[float]] = []  # weight, label sum, vote sum
    order = np.argsort(votes, kind="stable")
    for value in np.unique(votes[order]):
        at = votes == value
        pools.append([weight[at].sum(), (weight * labels)[at].sum(), (weight * votes)[at].sum()])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    half = 0.5 * (weight.min() if len(weight) else 1.0)
    x = np.array([p[2] / p[0] for p in pools])
    y = np.array([(p[1] + half) / (p[0] + 2 * half) for p in pools])
    return x, np.maximum.accumulate(y) if len(y) else y


def average_precision(votes: np.ndarray, labels: np.ndarray) -> float:
    """Mean share of label 1 among the examples with votes as large, over the examples of label 1."""
    value, at = np.unique(-votes, return_inverse=True)
    hits = np.cumsum(np.bincount(at, labels, minlength=len(value)))
    share = hits / np.cumsum(np.bincount(at, minlength=len(value)))
    return float(share[at][labels == 1].mean()) if labels.any() else 0.0


# --- fitting ---


def sample_labels(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> tuple[DataFrame, list[int]]:
    """``label_id, toxic`` of up to ``examples`` rows per class, by a hash of their id, and the classes' full sizes.

    Only documents of the table whose crc32 modulo 3 is not 1 take part. Of several labels of one id the largest counts;
    rows without id or label are left out.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic in (0, 1)").filter(crc_mod("doc_id", 3) != 1)
    known = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    present = docs.select(F.col("doc_id").cast("bigint").alias("present_id"))
    known = known.join(present, F.col("label_id") == F.col("present_id"), "left_semi")
    known = stored(known, run_dir(docs.sparkSession, "toxicity-labels"))
    sizes = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    by_hash = F.xxhash64("label_id")
    picked = [known.filter(F.col("toxic") == c).orderBy(by_hash, "label_id").limit(examples) for c in (0, 1)]
    return picked[0].union(picked[1]), [sizes.get(0, 0), sizes.get(1, 0)]


def example_rows(docs: DataFrame, picked: DataFrame, examples: int, most_bytes: int) -> DataFrame:
    """The picked documents with their texts, one row for each, as far as the bytes of both classes go: the sample is
    bounded whatever the texts are."""
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")
    rows = rows.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= most_bytes // 2)
    # Of several texts with one id the first counts; ids are at most two times ``examples``.
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    so_far = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(
        Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = rows.withColumn("so_far", so_far).filter(F.col("so_far") <= most_bytes // 2).drop("so_far")
    return stored(rows, run_dir(docs.sparkSession, "toxicity-sample"))


def counted(rows: list[tuple[int, str | None, int]], sizes: list[int]) -> Examples:
    """From ``(id, text, label)`` of the examples and the classes' full sizes."""
    rows = sorted(rows, key=lambda r: (r[0], r[2], r[1] or ""))
    ids, label = np.array([r[0] for r in rows], np.int64), np.array([r[2] for r in rows], float)
    texts, n = np.array([text_hash(r[1]) for r in rows], np.int64), np.bincount(label.astype(int), minlength=2)
    words = {w for _, text, _ in rows for w in words_of(text)}
    vocabulary = sorted({t for w in words for t in word_terms(w)})
    words.clear()
    terms = Terms(vocabulary)
    size, vocabulary = len(vocabulary), ["\n".join(vocabulary[at : at + 4096]) for at in range(0, len(vocabulary), 4096)]
    term, counts, held = [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)], []
    for at in range(0, len(rows), BATCH):
        some = list(terms.counts_of([text for _, text, _ in rows[at : at + BATCH]]))
        held += [len(t) for t, *_ in some]
        term.append(np.concatenate([t for t, *_ in some]).astype(np.int32))
        times = np.concatenate([c for _, c, _ in some])
        counts.append(times.astype(np.min_scalar_type(times.max(initial=0))))
    del terms, rows
    term, counts = np.concatenate(term), np.concatenate(counts)
    example = np.repeat(np.arange(len(ids)).astype(np.min_scalar_type(len(ids))), held)
    with_label = np.zeros((2, size), np.int64)
    for some in slices(len(term)):
        toxic = label[example[some]] == 1
        with_label += [np.bincount(term[some][toxic == c], minlength=size) for c in (0, 1)]
    scale = (np.log((1 + len(ids)) / (1 + with_label.sum(axis=0))) + 1) * relevance(*with_label, *n[:2])
    weight, square = np.empty(len(term), np.float32), np.zeros(len(ids))
    for some in slices(len(term)):
        full = np.log1p(counts[some], dtype=float) * scale[term[some]]
        square += np.bincount(example[some], full**2, minlength=len(ids))
        weight[some] = full
    length = np.sqrt(square)
    for some in slices(len(term)):
        weight[some] /= length[example[some]]
    # Which examples share a block needs no exact weights.
    of = neighbourly(example, term, weight, len(ids), size, BLOCK)
    del weight
    lists = Lists.laid(term, counts, places(of).astype(np.min_scalar_type(max(len(of) - 1, 0)))[example], size)
    return Examples(
        vocabulary, scale, lists, of, np.where(length > 0, length, 1.0), ids, label, np.array([sizes[int(y)] / n[int(y)] for y in label]),
        texts, sizes[1] / sum(sizes) if sum(sizes) else 0.0,
    )


def model_of(data: bytes) -> Model:
    return kept(data, lambda: Model(Examples.unpacked(data)))


@dataclass(frozen=True)
class Learned:
    """A fitted model on its way: packed examples as a broadcast value, and what their own votes have set."""

    examples: Broadcast[bytes]
    k: int
    knots: tuple[np.ndarray, np.ndarray]

    def model(self) -> Model:
        model = model_of(self.examples.value)
        model.k, model.knots = self.k, self.knots
        return model


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, most_bytes: int = EXAMPLE_BYTES) -> Learned:
    """Learn from labelled documents; ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``toxic``. No
    labels give a model that knows nothing."""
    spark = docs.sparkSession
    docs = private(docs, ["doc_id", "text"])
    picked, sizes = sample_labels(docs, labels, examples)
    sample = example_rows(docs, picked, examples, most_bytes)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        rows = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic")))]
        yield pa.RecordBatch.from_arrays([pa.array([counted(rows, sizes).packed()], pa.binary())], names=["examples"])

    # The sample is bounded by its parameters: one task holds it, and its packed counts pass through the driver.
    learned = [bytes(r[0]) for r in sample.repartition(1).mapInArrow(learn, "examples binary").collect()]
    handed = spark.sparkContext.broadcast(learned.pop() if learned else counted([], sizes).packed())

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with in_use():
            model = model_of(handed.value)
            for batch in batches:
                found = model.neighbours(batch.column("text").to_pylist(), NEIGHBOURS[-1])
                votes = [[model.vote(f[:k], c[:k]) for k in NEIGHBOURS] for f, c in found]
                columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(votes, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "votes"])

    rows = sample.repartition(16).mapInArrow(own, "doc_id bigint, toxic int, votes array<double>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.toxic))
    if not rows:
        return Learned(handed, NEIGHBOURS[-1], (np.zeros(0), np.zeros(0)))
    label, votes = np.array([r.toxic for r in rows], float), np.array([r.votes for r in rows])
    # The number of neighbours that puts the examples of label 1 first; of equal ones the largest.
    best = max(range(len(NEIGHBOURS)), key=lambda i: (round(average_precision(votes[:, i], label), 3), i))
    weight = np.array([sizes[r.toxic] / (label == r.toxic).sum() for r in rows])
    return Learned(handed, NEIGHBOURS[best], isotonic(votes[:, best], label, weight))


def scored(docs: DataFrame, learned: Learned, score: str = "score", evidence: str = "evidence") -> DataFrame:
    """All rows and columns, with a score (0 to 1) and evidence (ids of the nearest examples) after them.

    A null text or one without any term of the examples has no neighbours and gets the labels' own share. A null id is handed
    on, repeated rows get equal scores, an empty table gives an empty result. Columns of the two names are replaced.
    """
    added = [score, evidence]
    keep = docs.drop(*added)
    at = keep.columns.index("text")
    schema = T.StructType([*keep.schema, T.StructField(score, T.DoubleType()), T.StructField(evidence, T.ArrayType(T.LongType()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with in_use():
            model = learned.model()
            for batch in batches:
                found = list(model.score(batch.column(at).to_pylist()))
                scores, near = [f[0] for f in found], [f[1].tolist() for f in found]
                arrays = [*batch.columns, pa.array(scores, pa.float64()), pa.array(near, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *added])

    return keep.mapInArrow(rows, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence``, one row per document.

    Null texts and texts without a known term get the labels' own share as score, and no evidence; without any labels that
    is zero. Repeated rows get equal results, a null id is handed on, an empty table gives an empty result. Of the
    documents' columns only ``doc_id`` and ``text`` are read, and no score depends on the first.
    """
    rows = scored(private(docs, ["doc_id", "text"]), fit(docs, labels))
    return rows.select(
        "doc_id",
        (crc_mod("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence",
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents under the threshold, with all their columns, whatever these are called. Null and empty texts,
    repeated rows and rows without id are judged like any other row; an empty table stays empty."""
    score, evidence = own_names(docs, "score", "evidence")
    rows = scored(docs, fit(docs, labels), score, evidence)
    return rows.filter(F.col(score) < threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
