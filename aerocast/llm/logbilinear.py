"""Log-bilinear language model with noise-contrastive estimation.

Tokens are the lower-case words of a text and one end. The most frequent tokens are classes of their
own; all others are grouped by their first two bytes. Every token of a group that is seen
``LEAST_COUNT`` times is a word with its own representation, so the vocabulary grows with the
corpus. The words of a group are sorted by count and cut into subclasses of four times the square
root of their number; one more subclass is for the tokens below the count, which share the
representation of the group.

The model predicts a token from the two tokens before it: the sum of their representations, each
through the matrix of its position, is compared with the vector of every class, inside a group with
the vector of every subclass, and inside a subclass with the vector of every word of it. All three
softmaxes are normalised in full, as batched products over the distinct contexts. A token below the
count has its add-one share of the subclass's count, with one unit left for tokens never seen, so
that the probabilities of all tokens sum to one.

Counts come from every training text. The network starts from the frequencies and learns from every
token in numpy. How the table is split plays no part: texts are dealt anew to as many copies of the
network as there are ``COPY_TOKENS`` in them, so that a copy learns from about that many tokens at any
size. The first copy learns alone, and all others start from what it has learned, which keeps them
close enough to be averaged: by token count, and the vectors of a word by the number of times that it
was met; what no copy met stays. Means are taken over ``FAN`` copies at a time, in as many steps as needed. The driver and
every worker hold the vectors of all words, about 150 bytes a word.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.llm.words import chunks, slices, split_words
from aerocast.session import materialise

FOLDS = 7
HELD_OUT = 2
OWN_CLASSES = 255
GROUPS = 128
#: Most frequent tokens whose counts every worker has; the counts of all others are joined.
KNOWN_TOKENS = 500_000
WIDTH = 16
NOISE = 16
BATCH = 2048
ROUNDS = 1
#: Tokens that a copy of the network learns from before copies are averaged, and copies averaged at once.
COPY_TOKENS = 8_000_000
FAN = 64
#: Times that a token must be seen to have its own representation.
LEAST_COUNT = 8
#: Noise of a target inside its group or subclass, and the step of the vectors there.
WORD_NOISE = 4
WORD_RATE = 0.1
#: Columns of an entry's row while it learns, after its vector: bias, squared slopes of vector and bias, times met.
SHIFT, SQUARES, SHIFT_SQUARES, MET = range(WIDTH, WIDTH + 4)
COLUMNS = WIDTH + 4
WHOLE_ROW = np.dtype(("V", 4 * COLUMNS))
#: Ranges of equal probability an entry, by which noise is drawn.
CELLS = 4
#: Entries whose vectors are averaged and sent to the driver together.
SHARD = 1024
#: Rows and text bytes that are scored together: contexts that they share are normalised once.
SCORED_ROWS, SCORED_BYTES = 2048, 1 << 22
#: Scores that are in memory at once while a context is normalised, and the size up to which none needs a shift.
SCORES = 1 << 16
SAFE = 60
#: Rows of vectors that are multiplied at once.
ROWS = 1 << 12
SEED = 7
END = np.uint64(0x5EED0E4D)
#: Distinct tokens that a counting task holds before it passes them on.
HELD_TOKENS = 1_000_000


def is_held_out(doc_id: Column) -> Column:
    """Rows that the model does not learn from: crc32 of the id as text is 2 modulo 7."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def tokens_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, group code, first) of all tokens; ``first`` has the first token of each text, then the total.

    The group code is the number of the first two bytes; the end, like no word, has code -1.
    """
    words = split_words(texts, lower=True)
    n, total = len(texts), len(words.starts) + len(texts)
    first = words.first + np.arange(n + 1)
    is_word = np.ones(total, bool)
    is_word[first[1:] - 1] = False
    at = np.flatnonzero(is_word)
    hashes, codes = np.full(total, END, np.uint64), np.full(total, -1, np.int64)
    hashes[at] = words.hashes()
    second = words.data.take(words.starts + 1, mode="clip") * (words.ends - words.starts > 1)
    codes[at] = words.data.take(words.starts).astype(np.int64) * 256 + second
    return hashes, codes, first


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def count_tokens(docs: DataFrame) -> DataFrame:
    """``token, code, n`` over all texts, where token is a 64-bit hash as a long."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tokens, codes, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(tokens)
        tokens = tokens[order]
        first = np.flatnonzero(np.append(len(tokens) > 0, tokens[1:] != tokens[:-1]))
        return tokens[first], codes[order[first]], np.add.reduceat(counts[order], first)

    def rows(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array(part[0].view(np.int64)), pa.array(part[1]), pa.array(part[2])]
        return pa.RecordBatch.from_arrays(columns, names=["token", "code", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in slices(batches):
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for part in chunks(texts):
                tokens, codes, _ = tokens_of(texts[part])
                held.append(merged([(tokens, codes, np.ones(len(tokens), np.int64))]))
                if sum(len(h[0]) for h in held) > 2 * HELD_TOKENS:
                    held = [merged(held)]
                    if len(held[0][0]) > HELD_TOKENS:
                        yield rows(held.pop())
        if held:
            yield rows(merged(held))

    counted = docs.select("text").mapInArrow(count, "token long, code long, n long")
    return counted.groupBy("token", "code").agg(F.sum("n").alias("n"))


class _Groups:
    """Equal values of an index: the distinct ones, the place of each among them, the order that sorts them."""

    def __init__(self, index: np.ndarray) -> None:
        bits = len(index).bit_length()
        keys = np.sort((index.astype(np.int64) << bits) | np.arange(len(index)))
        self.order, values = keys & ((1 << bits) - 1), keys >> bits
        new = np.ones(len(index), bool)
        np.not_equal(values[1:], values[:-1], out=new[1:])
        self.first, self.again, groups = np.flatnonzero(new), np.flatnonzero(~new), np.cumsum(new) - 1
        self.values, self.times = values[self.first], np.diff(np.append(self.first, len(index)))
        self.at, self.of_again = np.empty(len(index), np.int64), groups[self.again]
        self.at[self.order] = groups

    def sums(self, rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sums by distinct value of the rows that are given for places in the index."""
        out = rows_of(self.order.take(self.first))
        if len(self.again):
            heads = np.flatnonzero(np.append(True, self.of_again[1:] != self.of_again[:-1]))
            out[self.of_again[heads]] += np.add.reduceat(rows_of(self.order.take(self.again)), heads, axis=0)
        return out


@dataclass
class Model:
    """Vocabulary by hash, classes, and the network; see the module text."""

    known: np.ndarray
    known_counts: np.ndarray
    own: np.ndarray
    group_codes: np.ndarray
    group_counts: np.ndarray
    group_sizes: np.ndarray
    total: int
    distinct: int
    share: np.ndarray
    #: Place among the words of each known token, or -1; words are in the order of their subclasses.
    word_at: np.ndarray
    #: First word of each subclass, then the number of words; group of each subclass.
    word_starts: np.ndarray
    word_groups: np.ndarray
    #: Counts of entries: for each group the tokens below the count (and one) and its subclasses, then all words.
    entry_counts: np.ndarray
    #: First entry of each group and of each subclass, then the number of entries.
    entry_starts: np.ndarray
    #: Counts and numbers of tokens below the count, by group.
    rare_counts: np.ndarray
    rare_sizes: np.ndarray
    parameters: list[np.ndarray] | None = None
    #: Log of each entry's share of the count of its group or subclass.
    entry_bias: np.ndarray | None = None
    #: By entry: what a word's representation adds to that of its group, the vector as a target, and the
    #: bias beyond the log share; all zero before training.
    entry_parameters: list[np.ndarray] | None = None

    @property
    def classes(self) -> int:
        return len(self.own) + len(self.group_codes) + 1

    @property
    def words(self) -> int:
        return int(self.word_starts[-1])

    @property
    def nodes(self) -> int:
        """Entries before the words."""
        return len(self.group_codes) + 1 + len(self.word_groups)

    @cached_property
    def unit_classes(self) -> np.ndarray:
        """Class of each unit."""
        of_words = len(self.own) + np.repeat(self.word_groups, np.diff(self.word_starts))
        return np.concatenate((np.arange(self.classes + 1), of_words))

    @cached_property
    def subclass_of(self) -> np.ndarray:
        """Subclass of each word, and one more for the number -1 of no word."""
        return np.append(np.repeat(np.arange(len(self.word_groups)), np.diff(self.word_starts)), 0).astype(np.int32)

    @cached_property
    def _lookup(self) -> tuple[np.ndarray, ...]:
        """Known tokens and a last one; the first known token of each prefix; own class of each known token, or -1; class of each code."""
        bits = len(self.known).bit_length()
        prefixes = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
        own = np.full(len(self.known) + 1, -1, np.int32)
        own[np.searchsorted(self.known, self.own)] = np.arange(len(self.own))
        by_code = np.full((1 << 16) + 1, self.classes - 1)
        by_code[self.group_codes] = len(self.own) + np.arange(len(self.group_codes))
        ended = np.append(self.known, np.uint64(2**64 - 1))
        return ended, np.searchsorted(self.known, prefixes).astype(np.int32), own, by_code, np.uint64(64 - bits)

    def known_at(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token among the known ones, and whether it is there."""
        known, first, _, _, shift = self._lookup
        # Hashes spread evenly, so the place is a few steps from the first one of a prefix, or else found by bisection.
        at = first.take((tokens >> shift).astype(np.int64)).astype(np.int64) if len(self.known) else np.zeros(len(tokens), np.int64)
        left = np.flatnonzero(known.take(at) < tokens)
        for _ in range(4):
            at[left] += 1
            left = left[known.take(at[left]) < tokens[left]]
        at[left] = np.searchsorted(known, tokens[left])
        return at, (known.take(at) == tokens) & (at < len(self.known))

    def places_of(self, tokens: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own class, else the group of the code, else the last class for all other codes; and the word, -1 where there is none."""
        return self.places_at(*self.known_at(tokens), codes)

    def places_at(self, at: np.ndarray, is_known: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same from the places among the known tokens."""
        _, _, own, by_code, _ = self._lookup
        own_class = np.where(is_known, own.take(at), -1)
        classes = np.where(own_class >= 0, own_class, by_code.take(codes, mode="wrap"))
        return classes, np.where(is_known, np.append(self.word_at, -1).take(at), -1)

    def classes_of(self, tokens: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.places_of(tokens, codes)[0]

    def units_of(self, classes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """What a token is as a context: its class, or a number beyond ``classes`` for each word."""
        return np.where(words >= 0, self.classes + 1 + words, classes)

    def contexts(self, units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of the token before and of the one before that; the number of classes before a text."""
        outside = self.classes
        one = np.concatenate(([outside], units[:-1]))
        one[first[:-1]] = outside
        two = np.concatenate(([outside], one[:-1]))
        two[first[:-1]] = outside
        return one, two

    def split(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, word) of units; the word is -1 for a unit that is no word."""
        words = np.where(units > self.classes, units - self.classes - 1, -1)
        return self.unit_classes.take(units), words

    def inside(self, classes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, entry, parent) of the choices below the classes: of a subclass in its group, and of a word in its subclass.

        Choices of the only entry of a parent are certain and left out.
        """
        in_group = np.flatnonzero(classes >= len(self.own))
        group, word = classes[in_group] - len(self.own), words[in_group]
        is_word = word >= 0
        subclass = self.subclass_of.take(word).astype(np.int64)
        entry = np.where(is_word, subclass + group + 1, self.entry_starts[group])
        place = np.concatenate((in_group, in_group[is_word]))
        entry = np.concatenate((entry, self.nodes + word[is_word]))
        parent = np.concatenate((group, len(self.group_codes) + 1 + subclass[is_word]))
        open_ = np.flatnonzero(np.diff(self.entry_starts)[parent] > 1)
        return place[open_], entry[open_], parent[open_]

    def log_shares(self) -> np.ndarray:
        """Log of each entry's share of the count of its parent."""
        sums = np.add.reduceat(self.entry_counts, self.entry_starts[:-1])
        return np.log(self.entry_counts / np.repeat(sums, np.diff(self.entry_starts))).astype(np.float32)

    def start(self) -> list[np.ndarray]:
        """Representations, class vectors, a matrix per position and the biases, before training."""
        rng = np.random.default_rng(SEED)
        words = rng.normal(0, 0.1, (self.classes + 1, WIDTH))
        out = rng.normal(0, 0.1, (self.classes, WIDTH))
        return [words, out, np.eye(WIDTH), np.eye(WIDTH) * 0.5, np.log(self.share)]

    def start_entries(self) -> list[np.ndarray]:
        n = len(self.entry_counts)
        return [np.zeros((n, WIDTH), np.float32), np.zeros((n, WIDTH), np.float32), np.zeros(n, np.float32)]

    def train(
        self, parameters: list[np.ndarray], entry_parameters: list[np.ndarray], batches: Iterator[tuple[np.ndarray, ...]], seed: int
    ) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, int]:
        """One pass of noise-contrastive estimation by AdaGrad over batches of (class, word, unit, unit).

        Returns the parameters, those of the entries, how often each entry was met as context and as
        target or noise, and the number of tokens.
        """
        words, out, near, far, bias = (p.astype(np.float32) for p in parameters)
        # One row an entry, so that a step reads and writes it once: as a choice, and without a bias as a context.
        choices, contexts = (np.zeros((len(self.entry_counts), COLUMNS), np.float32) for _ in range(2))
        contexts[:, :WIDTH], choices[:, :WIDTH], choices[:, SHIFT] = entry_parameters
        for rows in (choices, contexts):
            rows[:, SQUARES : SHIFT_SQUARES + 1] = 1
        sums = [np.full(p.shape, 1e-3, np.float32) for p in parameters]
        rng, log_noise = np.random.default_rng(seed), np.log(NOISE * self.share).astype(np.float32)
        upto = np.cumsum(self.share)
        upto /= upto[-1]
        n_classes, seen, noise_inside = len(words), 0, self.noise_inside()

        def step(i: int, value: np.ndarray, slope: np.ndarray) -> None:
            sums[i] += slope * slope
            value -= 0.1 * slope / np.sqrt(sums[i])

        cells = np.arange(n_classes * WIDTH).reshape(n_classes, WIDTH)

        def gathered(index: np.ndarray, slopes: np.ndarray, n: int) -> np.ndarray:
            return np.bincount(cells.take(index, 0).ravel(), slopes.ravel(), n * WIDTH).reshape(n, WIDTH).astype(np.float32)

        # The slopes of a row as the means of their squares, and the columns that each mean stands for.
        squares, spread = np.zeros((COLUMNS, 2), np.float32), np.zeros((2, COLUMNS), np.float32)
        squares[:WIDTH, 0], squares[SHIFT, 1], spread[0, :WIDTH], spread[1, SHIFT] = 1 / WIDTH, 1, WORD_RATE, WORD_RATE

        def step_rows(table: np.ndarray, met: _Groups, rows: np.ndarray, slope: np.ndarray) -> None:
            """A step of the rows of entries met; the slopes are zero but for vector and bias."""
            rows[:, SQUARES : SHIFT_SQUARES + 1] += (slope * slope) @ squares
            rows -= slope * ((1 / np.sqrt(rows[:, SQUARES : SHIFT_SQUARES + 1])) @ spread)
            rows[:, MET] += met.times
            np.put(table.view(WHOLE_ROW)[:, 0], met.values, rows.view(WHOLE_ROW)[:, 0])

        for target, word, one, two in batches:
            (one, one_word), (two, two_word) = self.split(one), self.split(two)
            a, b = words.take(one, 0), words.take(two, 0)
            one_is, two_is = (np.flatnonzero(x >= 0) for x in (one_word, two_word))
            of_words = _Groups(self.nodes + np.concatenate((one_word[one_is], two_word[two_is])))
            held = contexts.take(of_words.values, 0)
            own = held.take(of_words.at, 0)[:, :WIDTH]
            a[one_is] += own[: len(one_is)]
            b[two_is] += own[len(one_is) :]
            predicted = a @ near + b @ far
            of_target = out.take(target, 0)
            noise = np.searchsorted(upto, rng.random(NOISE), "right")
            good = (predicted * of_target) @ np.ones(WIDTH, np.float32) + bias[target] - log_noise[target]
            bad = predicted @ out[noise].T + bias[noise] - log_noise[noise]
            g = -1 / (1 + np.exp(np.clip(good, -30, 30)))
            h = 1 / (1 + np.exp(-np.clip(bad, -30, 30)))
            by_predicted = g[:, None] * of_target + h @ out[noise]
            by_out = gathered(target, g[:, None] * predicted, self.classes)
            np.add.at(by_out, noise, h.T @ predicted)
            by_bias = np.bincount(target, g, self.classes).astype(np.float32)
            np.add.at(by_bias, noise, np.ones(len(h), np.float32) @ h)
            place, entry, parent = self.inside(target, word)
            if len(place):
                # Below the classes: noise by the counts inside the parent; the bias starts from the same shares.
                index = np.concatenate((entry[None], noise_inside(rng, parent)))
                met = _Groups(index.ravel())
                rows = choices.take(met.values, 0)
                vectors = rows.take(met.at, 0).reshape(*index.shape, COLUMNS)
                # The one beside the prediction meets the bias, the zeros what else is in a row.
                mine = np.zeros((len(target), COLUMNS), np.float32)
                mine[:, :WIDTH], mine[:, SHIFT] = predicted, 1
                mine = mine.take(place, 0)
                scores = (vectors * mine).reshape(-1, COLUMNS) @ np.ones(COLUMNS, np.float32) - np.float32(np.log(WORD_NOISE))
                error = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
                error[: len(place)] -= 1
                back = np.einsum("ji,jik->ik", error.reshape(index.shape), vectors)[:, :WIDTH]
                # A token's places are a subclass and a word, each part in the order of the tokens.
                cut = int(np.argmax(np.append(place[1:] <= place[:-1], True))) + 1
                by_predicted[place[:cut]] += back[:cut]
                by_predicted[place[cut:]] += back[cut:]
                owner = np.tile(np.arange(len(place)), len(index))
                slope = met.sums(lambda at: mine.take(owner.take(at), 0) * error.take(at)[:, None])
                step_rows(choices, met, rows, slope)
            by_one, by_two = by_predicted @ near.T, by_predicted @ far.T
            by_words = gathered(np.concatenate((one, two)), np.concatenate((by_one, by_two)), n_classes)
            if len(of_words.values):
                slopes = np.zeros((len(of_words.at), COLUMNS), np.float32)
                slopes[: len(one_is), :WIDTH], slopes[len(one_is) :, :WIDTH] = by_one.take(one_is, 0), by_two.take(two_is, 0)
                step_rows(contexts, of_words, held, of_words.sums(lambda at: slopes.take(at, 0)))
            scale = np.float32(1 / len(target))
            slopes = (by_words, by_out, a.T @ by_predicted, b.T @ by_predicted, by_bias)
            for i, (value, slope) in enumerate(zip((words, out, near, far, bias), slopes)):
                step(i, value, slope * scale)
            seen += len(target)
        of_entries = [contexts[:, :WIDTH], choices[:, :WIDTH], choices[:, SHIFT]]
        return [words, out, near, far, bias], of_entries, np.stack((contexts[:, MET], choices[:, MET])), seen

    def noise_inside(self) -> Callable[[np.random.Generator, np.ndarray], np.ndarray]:
        """A function that draws WORD_NOISE entries of each given parent, by their counts."""
        first, sizes = self.entry_starts[:-1], np.diff(self.entry_starts)
        totals = np.concatenate(([0], np.cumsum(self.entry_counts)))
        low, width = totals[first], totals[self.entry_starts[1:]] - totals[first]
        # Every parent has CELLS equal ranges an entry; the first entry of each, from one count below for the rounding.
        of_cell = np.repeat(np.arange(len(sizes)), CELLS * sizes)
        cell = np.arange(len(of_cell)) - CELLS * first[of_cell]
        begin = low[of_cell] + np.maximum(np.floor(cell / (CELLS * sizes[of_cell]) * width[of_cell]).astype(np.int64) - 1, 0)
        guide = (np.searchsorted(totals, begin, "right") - 1).astype(np.int32)

        def draw(rng: np.random.Generator, parent: np.ndarray) -> np.ndarray:
            part = np.ascontiguousarray(rng.random((len(parent), WORD_NOISE)).T)
            wanted = (low.take(parent) + (part * width.take(parent)).astype(np.int64)).ravel()
            drawn = guide.take(CELLS * first.take(parent) + (part * (CELLS * sizes.take(parent))).astype(np.int64)).ravel()
            # A few entries further on, or else by bisection.
            drawn += totals.take(drawn + 1) <= wanted
            left = np.flatnonzero(totals.take(drawn + 1) <= wanted)
            drawn[left] = np.searchsorted(totals, wanted[left], "right") - 1
            return drawn.reshape(part.shape)

        return draw

    def predicted(self, units: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """What contexts predict, given as two places among the units."""
        words, _, near, far, _ = (p.astype(np.float32) for p in self.parameters)
        classes, own = self.split(units)
        out, is_word = words.take(classes, 0), np.flatnonzero(own >= 0)
        out[is_word] += self.entry_parameters[0].take(self.nodes + own[is_word], 0)
        return (out @ near).take(one, 0) + (out @ far).take(two, 0)

    def log_probabilities(self, classes: np.ndarray, own: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Log of the probability of each class after two units, and of the subclass and the word in it where there are any."""
        out, bias = self.parameters[1].astype(np.float32), self.parameters[4].astype(np.float32)
        units, at = _distinct(np.concatenate((one, two)), self.classes + 1 + self.words)
        pairs, context = _distinct(at[: len(one)] * len(units) + at[len(one) :], len(units) ** 2)
        predicted, logs = self.predicted(units, *np.divmod(pairs, max(1, len(units)))), np.empty(len(pairs), np.float32)
        _, vectors, shift = self.entry_parameters
        # No score is beyond the product of the longest vectors; only long ones need a shift.
        longest = [float(np.sqrt(((x * x) @ np.ones(WIDTH, np.float32)).max(initial=0))) for x in (predicted, out, vectors)]
        safe = longest[0] * max(longest[1:]) < SAFE
        weights, rows = np.exp(bias), max(1, SCORES // len(out))
        held = np.empty(max(SCORES, len(out), int(np.diff(self.entry_starts).max())), np.float32)
        for begin in range(0, len(pairs), rows):
            at = slice(begin, begin + rows)
            logs[at] = _log_sums(predicted[at], out, weights, held, safe)
        value = (_dots(predicted, context, out, classes) + bias[classes] - logs[context]).astype(np.float64)
        # Every group and subclass that is met is normalised over all its entries, once per distinct context.
        place, entry, parent = self.inside(classes, own)
        if not len(place):
            return value
        bias = self.entry_bias + shift
        met, at_met = _distinct(parent * len(pairs) + context[place], len(self.entry_starts) * len(pairs))
        parent, contexts = np.divmod(met, len(pairs))
        weights, logs = np.exp(bias), np.empty(len(met), np.float32)
        borders = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1], [True])))
        starts, ends = (self.entry_starts[parent[borders[:-1]] + i].tolist() for i in (0, 1))
        for begin, end, first, last in zip(borders[:-1].tolist(), borders[1:].tolist(), starts, ends):
            rows = max(1, SCORES // (last - first))
            for low in range(begin, end, rows):
                at = slice(low, min(end, low + rows))
                logs[at] = _log_sums(predicted.take(contexts[at], 0), vectors[first:last], weights[first:last], held, safe)
        scores = _dots(predicted, context[place], vectors, entry) + bias[entry]
        return value + np.bincount(place, scores - logs[at_met], len(classes))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores of each class after each class by position, biases, and log sums of all pairs of classes.

        For looking into a small model: contexts of single words are beyond a table.
        """
        words, out, near, far, bias = self.parameters
        one, two = words @ near @ out.T, words @ far @ out.T
        logs = np.empty((len(words), len(words)))
        for i in range(len(words)):
            scores = two + (one[i] + bias)
            top = scores.max(1)
            logs[i] = top + np.log(np.exp(scores - top[:, None]).sum(1))
        return one, two, bias, logs


def _log_sums(predicted: np.ndarray, vectors: np.ndarray, weights: np.ndarray, held: np.ndarray, safe: bool) -> np.ndarray:
    """Log of the weighted sum of exponentials of each prediction's scores, which take the memory given."""
    scores = np.matmul(predicted, vectors.T, out=held[: len(predicted) * len(vectors)].reshape(len(predicted), len(vectors)))
    if not safe:
        top = scores.max(1)
        scores -= top[:, None]
    np.exp(scores, out=scores)
    sums = np.log(scores @ weights)
    return sums if safe else top + sums


def _dots(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Products of rows of two arrays, a few rows at a time."""
    out, ones = np.empty(len(at_a), np.float32), np.ones(WIDTH, np.float32)
    for begin in range(0, len(out), ROWS):
        at = slice(begin, begin + ROWS)
        out[at] = (a.take(at_a[at], 0) * b.take(at_b[at], 0)) @ ones
    return out


def _distinct(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, which are below ``most``, and the place of each value among them."""
    if most.bit_length() + len(values).bit_length() > 63:
        return np.unique(values, return_inverse=True)
    groups = _Groups(values)
    return groups.values, groups.at


def _vocabulary(counts: DataFrame, own_classes: int, groups: int, known_tokens: int, least_count: int) -> Model:
    """Classes, words and the counts that every worker gets.

    Only the words, seen ``least_count`` times at least, grow with the corpus.
    """
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    # The counts from which on a token is known: a histogram over 64 steps per doubling, then one filter.
    steps = counts.groupBy(F.floor(F.log2("n") * 64).alias("step")).agg(F.count("*").alias("tokens"), F.min("n").alias("least"))
    least, held = None, 0
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):
        held += row["tokens"]
        if held > known_tokens:
            break
        least = row["least"]
    # Words are known to every worker, whatever their number.
    top = counts.filter(F.col("n") >= min(least or least_count, least_count)).toArrow()
    tokens, n, codes = (top.column(c).to_numpy() for c in ("token", "n", "code"))
    order = np.lexsort((tokens, -n))
    hashes, n, codes = tokens[order].view(np.uint64), n[order], codes[order]
    by_hash = np.argsort(hashes)
    own = np.sort(hashes[:own_classes])
    # Groups hold what is left of their codes: at most 65,537 rows, one per pair of bytes.
    by_code = counts.groupBy("code").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toArrow()
    left = {c: [a, b] for c, a, b in zip(*(by_code.column(x).to_pylist() for x in ("code", "n", "v")))}
    for code, count in zip(codes[:own_classes].tolist(), n[:own_classes].tolist()):
        left[code][0] -= count
        left[code][1] -= 1
    largest = sorted(left, key=lambda c: (-left[c][0], c))[:groups]
    group_codes = np.array(sorted(largest), np.int64)
    in_groups = [left.pop(int(c)) for c in group_codes]
    others = [sum(x) for x in zip([0, 0], *left.values())]
    sizes = np.array([*in_groups, others], np.int64).reshape(-1, 2)
    own_counts = dict(zip(hashes[:own_classes].tolist(), n[:own_classes].tolist()))
    class_counts = np.concatenate((np.array([own_counts[int(h)] for h in own], float), sizes[:, 0].astype(float)))
    share = (class_counts + 1) / (class_counts + 1).sum()
    # Words by group and then by count, cut into subclasses that do not reach over groups.
    word = own_classes + np.flatnonzero(n[own_classes:] >= least_count)
    group = np.searchsorted(group_codes, codes[word])
    group[np.append(group_codes, -2)[group] != codes[word]] = len(group_codes)
    by_group = np.argsort(group, kind="stable")
    word, group = word[by_group], group[by_group]
    in_group = np.bincount(group, minlength=len(sizes))
    place = np.arange(len(word)) - (np.cumsum(in_group) - in_group)[group]
    width = np.maximum(1, 4 * np.sqrt(in_group).astype(np.int64))
    heads = np.flatnonzero(place % width[group] == 0)
    word_at = np.full(len(n), -1)
    word_at[word] = np.arange(len(word))
    rare = sizes - np.stack((np.bincount(group, n[word], len(sizes)).astype(np.int64), in_group), 1)
    # The entries of a group are its tokens below the count, then its subclasses.
    subclass_counts = np.add.reduceat(n[word], heads) if len(word) else np.zeros(0, np.int64)
    subclasses = np.bincount(group[heads], minlength=len(sizes))
    first = np.cumsum(subclasses) - subclasses
    nodes = np.insert(subclass_counts, first, rare[:, 0] + 1)
    return Model(
        hashes[by_hash], n[by_hash], own, group_codes, sizes[:, 0], sizes[:, 1], int(total["n"] or 0), int(total["v"]), share,
        word_at[by_hash], np.append(heads, len(word)), group[heads], np.concatenate((nodes, n[word])),
        np.concatenate((first + np.arange(len(sizes)), len(nodes) + heads, [len(nodes) + len(word)])), rare[:, 0], rare[:, 1],
    )


#: Values of an entry that are sent when it was met as a context, and when as a choice.
SENT = (WIDTH, WIDTH + 1)


def _packed(index: np.ndarray, weights: np.ndarray, values: list[np.ndarray]) -> bytes:
    """Rows of one shard's entries as bytes, with weights of shape (2, n): place in the shard, times met, parameters in half precision.

    An entry has a row for each of its two parts that was met. Bytes of one kind lie together and are compressed.
    """
    vectors, parts, counts = (values[0], np.concatenate((values[1], values[2][:, None]), 1)), [], []
    for met, rows in zip(weights, vectors):
        at = np.flatnonzero(met)
        counts.append(len(at))
        for column in ((index[at] % SHARD).astype("<u2"), met[at].astype("<f4"), rows[at].astype("<f2")):
            parts.append(column.reshape(-1, 1).view(np.uint8).T.tobytes())
    return np.array(counts, "<u4").tobytes() + pa.compress(b"".join(parts), "zstd", asbytes=True)


def _unpacked(rows: pa.Buffer) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, times met, parameters) for the entries met as a context and for those met as a choice."""
    counts, out, begin = np.frombuffer(rows, "<u4", 2), [], 0
    sizes = [(n, kind, width) for n, sent in zip(counts.tolist(), SENT) for kind, width in (("<u2", 1), ("<f4", 1), ("<f2", sent))]
    size = sum(n * np.dtype(kind).itemsize * width for n, kind, width in sizes)
    data = np.frombuffer(pa.decompress(rows.slice(counts.nbytes), size, "zstd"), np.uint8)
    for n, kind, width in sizes:
        each = np.dtype(kind).itemsize
        column = data[begin : begin + n * width * each].reshape(each, n * width).T
        out.append(np.ascontiguousarray(column).view(kind).reshape(n, width))
        begin += n * width * each
    return [(out[i][:, 0].astype(np.int64), out[i + 1][:, 0], out[i + 2]) for i in (0, 3)]


def _mean_entries(parts: pa.ChunkedArray) -> bytes:
    """Rows of one shard's entries from several copies: every part of the parameters averaged by how often the entry was met."""
    unpacked = [_unpacked(x.as_buffer()) for x in parts]
    totals, means = np.zeros((2, SHARD)), [np.zeros((SHARD, n)) for n in SENT]
    for role in (0, 1):
        for place, met, values in (x[role] for x in unpacked):
            totals[role][place] += met
            means[role][place] += met[:, None].astype(np.float64) * values
        means[role] /= np.maximum(totals[role], 1)[:, None]
    return _packed(np.arange(SHARD), totals, [means[0], means[1][:, :WIDTH], means[1][:, WIDTH]])


#: What a copy sends: shard of entries, or -1 for the network; its number; its tokens; the parameters.
PART = "shard long, copy long, seen long, rows binary"


def _mean_of_copies(table: pa.Table) -> pa.Table:
    """One row for the rows of a shard; means weigh by tokens or times met, so means of means are right."""
    shard, copy, seen = table.column("shard")[0].as_py(), table.column("copy")[0].as_py(), table.column("seen").to_pylist()
    if shard >= 0:
        rows = _mean_entries(table.column("rows"))
    else:
        rows = (sum(n * np.frombuffer(x.as_buffer()) for n, x in zip(seen, table.column("rows"))) / sum(seen)).tobytes()
    return pa.table([pa.array([shard]), pa.array([copy]), pa.array([sum(seen)]), pa.array([rows], pa.binary())], names=table.column_names)


def _trained(texts: DataFrame, model: Model, copies: int, seed: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Every copy learns from its share of the texts; returns the mean of their parameters and of those of the entries."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        copy = TaskContext.get().partitionId()

        def tokens() -> Iterator[tuple[np.ndarray, ...]]:
            rng = np.random.default_rng([SEED, seed, copy])
            for batch in slices(batches):
                texts = batch.column(0).cast(pa.binary()).to_pylist()
                for part in chunks(texts):
                    hashes, codes, first = tokens_of(texts[part])
                    classes, words = own.places_of(hashes, codes)
                    one, two = own.contexts(own.units_of(classes, words), first)
                    order = rng.permutation(len(classes))
                    for begin in range(0, len(order), BATCH):
                        at = order[begin : begin + BATCH]
                        yield classes[at], words[at], one[at], two[at]

        def row(shard: int, seen: int, rows: bytes) -> pa.RecordBatch:
            columns = [pa.array([shard]), pa.array([copy]), pa.array([seen]), pa.array([rows], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "copy", "seen", "rows"])

        trained, of_entries, met, seen = own.train(own.parameters, own.entry_parameters or own.start_entries(), tokens(), copy)
        if seen:
            yield row(-1, seen, np.concatenate([p.ravel() for p in trained]).astype(np.float64).tobytes())
        rows = np.flatnonzero(met.any(0))
        borders = np.flatnonzero(np.concatenate(([True], rows[1:] // SHARD != rows[:-1] // SHARD, [True]))) if len(rows) else [0]
        for begin, end in zip(borders[:-1], borders[1:]):
            at = rows[begin:end]
            yield row(int(at[0] // SHARD), 0, _packed(at, met[:, at], [p[at] for p in of_entries]))

    # Dealt in turn, so that no key can fill a copy; the order inside a copy is that of hashes.
    order = [F.xxhash64("doc_id", "text"), F.col("doc_id"), F.col("text")]
    parts = texts.repartition(copies).sortWithinPartitions(*order).select("text").mapInArrow(train, PART)
    while copies > 1:
        copies = -(-copies // FAN)
        by_fan = parts.withColumn("copy", F.floor(F.col("copy") / FAN))
        parts = by_fan.groupBy("shard", "copy").applyInArrow(_mean_of_copies, PART)
    found = parts.select("shard", "rows").toArrow()
    shared.destroy()
    parameters, of_entries = model.parameters, model.entry_parameters or model.start_entries()
    for shard, rows in zip(found.column("shard").to_pylist(), found.column("rows")):
        if shard < 0:
            flat, out = np.frombuffer(rows.as_buffer()), []
            for shape in [p.shape for p in model.parameters]:
                size = int(np.prod(shape))
                out.append(flat[:size].reshape(shape))
                flat = flat[size:]
            parameters = out
            continue
        (of_context, _, context), (of_choice, _, choice) = _unpacked(rows.as_buffer())
        of_entries[0][shard * SHARD + of_context] = context
        of_entries[1][shard * SHARD + of_choice], of_entries[2][shard * SHARD + of_choice] = choice[:, :WIDTH], choice[:, WIDTH]
    return parameters, of_entries


def _training_round(texts: DataFrame, model: Model, number: int, copy_tokens: int) -> None:
    """One pass over all tokens; in the first one, the first copy learns before the others."""
    copies = max(1, round(model.total / copy_tokens))
    if number == 0 and copies > 1:
        drawn = F.rand(SEED) < 1 / copies
        model.parameters, model.entry_parameters = _trained(texts.filter(drawn), model, 1, 2 * number)
        texts, copies = texts.filter(~drawn), copies - 1
    model.parameters, model.entry_parameters = _trained(texts, model, copies, 2 * number + 1)


def train_language_model(
    docs: DataFrame,
    own_classes: int = OWN_CLASSES,
    groups: int = GROUPS,
    known_tokens: int = KNOWN_TOKENS,
    rounds: int = ROUNDS,
    least_count: int = LEAST_COUNT,
    copy_tokens: int = COPY_TOKENS,
) -> tuple[Model, DataFrame]:
    """The model and the stored counts, learned from all rows that are not held out.

    With up to one and a half times ``copy_tokens`` in all texts there is one copy, and the model is
    the same however the rows are split into partitions and ordered.
    """
    texts = _texts(docs).filter(~is_held_out(F.col("doc_id")))
    counts = materialise(count_tokens(texts), "token-counts")
    model = _vocabulary(counts, own_classes, groups, known_tokens, least_count)
    model.parameters, model.entry_bias = model.start(), model.log_shares()
    for number in range(rounds):
        _training_round(texts, model, number, copy_tokens)
    model.entry_parameters = model.entry_parameters or model.start_entries()
    return model, counts


def score_documents(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    A null or empty text is its end alone. Repeated rows are scored each for itself; a null id is
    not held out. An empty table gives no rows; other columns are dropped. With no training text
    every token is unseen.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        rare_total = np.log10(own.rare_counts + own.rare_sizes + 1.0)
        log_counts = np.log10(np.append(own.known_counts, 0) + 1.0)
        begin = TaskContext.get().partitionId() << 33
        for batch in slices(batches, SCORED_ROWS):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks(texts, SCORED_BYTES):
                n = part.stop - part.start
                tokens, codes, first = tokens_of(texts[part])
                owner = np.repeat(np.arange(n), np.diff(first))
                at, known = own.known_at(tokens)
                classes, words = own.places_at(at, known, codes)
                one, two = own.contexts(own.units_of(classes, words), first)
                value = own.log_probabilities(classes, words, one, two) / np.log(10)
                group = np.where(words < 0, classes - len(own.own), -1)
                value -= np.where(group >= 0, rare_total[np.maximum(group, 0)], 0)
                token_log = np.where(known, log_counts.take(at), 0)
                unknown = np.flatnonzero(~known)
                # A text's unknown tokens with their numbers of times, to be joined with the other counts.
                rest = np.stack((owner[unknown], tokens[unknown].view(np.int64)), 1)
                order = np.lexsort((rest[:, 1], rest[:, 0]))
                rest = rest[order]
                new = np.concatenate(([True], (rest[1:] != rest[:-1]).any(1))) if len(rest) else np.zeros(0, bool)
                starts = np.flatnonzero(new)
                times = np.diff(np.append(starts, len(rest)))
                borders = np.searchsorted(rest[starts, 0], np.arange(n + 1))
                offsets = pa.array(borders, pa.int32())
                columns = [
                    pa.array(begin + np.arange(n)),
                    batch.column(0)[part.start : part.stop],
                    pa.array(np.diff(first)),
                    pa.array(np.bincount(owner, known, n).astype(np.int64)),
                    pa.array(np.bincount(owner, token_log, n)),
                    pa.array(np.bincount(owner, value + np.where(group >= 0, token_log, 0), n)),
                    pa.ListArray.from_arrays(offsets, pa.array(rest[starts, 1])),
                    pa.ListArray.from_arrays(offsets, pa.array(times)),
                ]
                begin += n
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["row", "doc_id", "n_tokens", "known", "logs", "model", "rest", "times"]
    kinds = "row long, doc_id long, n_tokens long, known long, logs double, model double, rest array<long>, times array<long>"
    scored = materialise(_texts(docs).mapInArrow(score, kinds), "scored")
    # Tokens beyond the known ones are rare, so no key is hot; tokens that no training text has find no partner.
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("t"))
    rest = rest.select("row", F.col("t.rest").alias("token"), F.col("t.times").alias("times"))
    found = rest.join(counts.select("token", "n"), "token").groupBy("row")
    found = found.agg(F.sum("times").alias("_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("_logs"))
    joined = scored.drop("rest", "times").join(found, "row", "left")
    more, base = F.coalesce("_logs", F.lit(0.0)), float(np.log10(model.total + model.distinct + 1))
    return joined.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
