"""Language model: counts, normalisation, gain over the base, odd input."""

import math
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from aerocast.llm import logbilinear as lb
from tests.llm.awkward import TEXTS, documents, empty_documents


def tokens(text):
    lowered = (text or "").encode().translate(bytes(lb.np.where((lb.np.arange(256) >= 65) & (lb.np.arange(256) <= 90), lb.np.arange(256) + 32, lb.np.arange(256)).astype("u1")))
    return [*lowered.split(), None]


def base_scores(rows):
    """n_tokens, n_known, N and the base score of (id, text) rows, by hand."""
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(x for t in train for x in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for _, text in rows:
        found = [counts[x] for x in tokens(text)]
        out.append((len(found), sum(c > 0 for c in found), total, sum(math.log10((c + 1) / (total + distinct + 1)) for c in found)))
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    """Two languages that never mix, with rare words built from their own letters."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1500):
        common, letters = (["le", "la", "de", "et"], "éa") if i % 2 else (["the", "of", "and", "to"], "th")
        words = [rng.choice(common) if rng.random() < 0.5 else letters + "".join(rng.choice(list("abcd"), 4)) for _ in range(40)]
        rows.append((i, " ".join(words).title() if i % 3 == 0 else " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("known", [500_000, 5, 0])
def test_base_score_and_counts(spark, corpus, known):
    """The same counts, however many of them every worker has."""
    docs = corpus.limit(200)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = lb.score_documents(docs, *lb.train_language_model(docs, known_tokens=known, own_classes=3 if known else 0)).toPandas()
    got = out.set_index("doc_id").loc[[i for i, _ in rows]]
    want = base_scores(rows)
    assert list(zip(got.n_tokens, got.n_known, got.train_tokens)) == [w[:3] for w in want]
    assert np.allclose(got.base_score, [w[3] for w in want])


def test_probabilities_sum_to_one(corpus):
    model, counts = lb.train_language_model(corpus, own_classes=20, groups=6)
    one, two, bias, logs = model.tables()
    for a, b in ((0, 1), (5, 20), (model.classes, model.classes), (3, model.classes)):
        by_class = np.exp(one[a] + two[b] + bias - logs[a, b])
        assert by_class.sum() == pytest.approx(1)
    # Inside a group: all its tokens with count + 1, and one unit for what was never seen.
    rows = counts.toPandas()
    classes = model.classes_of(rows.token.to_numpy().view(np.uint64), rows.code.to_numpy())
    for g in range(len(model.group_codes) + 1):
        inside = rows.n[classes == len(model.own) + g]
        assert (inside.sum(), len(inside)) == (model.group_counts[g], model.group_sizes[g])


def test_beats_the_base_on_held_out_texts(corpus):
    out = lb.score_documents(corpus, *lb.train_language_model(corpus, own_classes=8, groups=8, rounds=3)).toPandas()
    held = out[out.held_out]
    assert 150 < len(held) < 300
    assert held.score.sum() > 0.9 * held.base_score.sum()


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = lb.score_documents(docs, *lb.train_language_model(docs)).toPandas()
    assert len(out) == len(rows) and np.isfinite(out.score).all()
    want = base_scores(rows)
    assert sorted(out.n_tokens) == sorted(w[0] for w in want)
    assert np.allclose(sorted(out.base_score), sorted(w[3] for w in want))
    nothing = out[out.doc_id.isin([0, 1, 2])]
    assert (nothing.n_tokens == 1).all() and nothing.score.nunique() == 1
    assert len(TEXTS) + 3 == len(rows)


def test_empty_table(spark):
    docs = empty_documents(spark)
    assert lb.score_documents(docs, *lb.train_language_model(docs)).count() == 0


@pytest.fixture(scope="module")
def common_beginnings(spark):
    """Two languages of 600 words each that all begin alike, and one text with 400 copies."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(3000):
        lang = "pq"[i % 2]
        rows.append((i, " ".join(f"wa{lang}{n}" for n in rng.integers(0, 600, 80)), lang))
    hot = " ".join(f"wap{n}" for n in rng.integers(0, 600, 80))
    rows += [(i, hot, "hot") for i in range(3000, 3400)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)


def test_every_word_above_the_count_is_predicted(common_beginnings):
    """With the production parameters: 1,200 words in one group of first bytes tell the language of the next word."""
    docs = common_beginnings
    out = lb.score_documents(docs, *lb.train_language_model(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    gains = out[out.held_out].groupby("lang").apply(lambda x: (x.score - x.base_score).sum() / x.n_tokens.sum(), include_groups=False)
    assert set(gains.index) == {"p", "q", "hot"} and (gains > 0.1).all(), gains.to_dict()


def test_vocabulary_grows_and_all_tokens_sum_to_one(common_beginnings):
    few, _ = lb.train_language_model(common_beginnings.filter("doc_id < 150"), rounds=0)
    model, counts = lb.train_language_model(common_beginnings)
    rows = counts.toPandas()
    assert model.words == (rows.n >= lb.LEAST_COUNT).sum() - len(model.own) > few.words > 0
    assert few.words < 946 and all(np.abs(p[model.nodes :]).sum() > 0 for p in model.entry_parameters)
    classes, words = model.places_of(rows.token.to_numpy().view(np.uint64), rows.code.to_numpy())
    for one, two in ((model.classes, model.classes), (model.classes + 1, 3), (model.classes + model.words, model.classes + 7)):
        # Each class, word and subclass of rare tokens once.
        rare = np.arange(len(model.own), model.classes)
        at_class = np.concatenate((np.arange(len(model.own)), rare, classes[words >= 0]))
        at_word = np.concatenate((np.full(model.classes, -1), words[words >= 0]))
        n = len(at_class)
        logs = model.log_probabilities(at_class, at_word, np.full(n, one), np.full(n, two))
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("parts", [8, 64])
def test_scores_do_not_depend_on_partitions(common_beginnings, parts):
    """With the production parameters: the same scores from one partition and from many."""
    one, many = (
        lb.score_documents(common_beginnings, *lb.train_language_model(common_beginnings.repartition(n))).toPandas().sort_values("doc_id")
        for n in (1, parts)
    )
    assert np.allclose(one.score, many.score)


def test_copies_learn_what_one_learns(common_beginnings):
    """Averaged copies keep three quarters of the gain of a single one, even with 60,000 tokens each."""
    def gain(**options):
        out = lb.score_documents(common_beginnings, *lb.train_language_model(common_beginnings, **options)).toPandas()
        held = out[out.held_out]
        return (held.score - held.base_score).sum() / held.n_tokens.sum()

    alone, four = gain(), gain(copy_tokens=60_000)
    assert alone > 0.1 and four > 0.75 * alone


def test_means_of_means(common_beginnings, monkeypatch):
    """Steps of two copies give the mean of all copies at once."""
    def parameters():
        model, _ = lb.train_language_model(common_beginnings, copy_tokens=40_000)
        return [*model.parameters, *model.entry_parameters]

    at_once = parameters()
    monkeypatch.setattr(lb, "FAN", 2)
    for a, b in zip(at_once, parameters()):
        assert np.allclose(a, b, atol=5e-3)


def small_model(seed=3, words=3000, own=20):
    """A model whose words have very unequal counts, with parameters that are not zero."""
    rng = np.random.default_rng(seed)
    sizes = np.array([1, 2, words // 3, words - words // 3 - 3])
    in_group, heads = np.repeat([0, 1, 2, 3], sizes), []
    for g, n in enumerate(sizes):
        heads += list(sizes[:g].sum() + np.arange(0, n, max(1, 4 * int(n**0.5))))
    heads = np.array(heads)
    counts = (1e6 / (1 + np.arange(words)) ** 1.2).astype(np.int64) + lb.LEAST_COUNT
    subclasses = np.bincount(in_group[heads], minlength=4)
    first = np.cumsum(subclasses) - subclasses
    nodes = np.insert(np.add.reduceat(counts, heads), first, [5, 1, 9, 2000])
    starts = np.concatenate((first + np.arange(4), len(nodes) + heads, [len(nodes) + words]))
    known = np.sort(rng.choice(2**62, own + words, replace=False).astype(np.uint64) * np.uint64(4))
    word_at = np.full(own + words, -1)
    word_at[own:] = rng.permutation(words)
    share = rng.random(own + 4)
    model = lb.Model(
        known, rng.integers(1, 99, own + words), known[:own], np.array([7, 300, 9000]), np.zeros(4), np.zeros(4), 1, 1, share / share.sum(), word_at,
        np.append(heads, words), in_group[heads], np.concatenate((nodes, counts)), starts, np.zeros(4), np.zeros(4),
    )
    model.parameters, model.entry_bias = model.start(), model.log_shares()
    n = len(model.entry_counts)
    model.entry_parameters = [rng.normal(0, 0.3, (n, lb.WIDTH)).astype("f4"), rng.normal(0, 0.3, (n, lb.WIDTH)).astype("f4"), rng.normal(0, 0.1, n).astype("f4")]
    return model, rng


def drawn_tokens(model, rng, n):
    """Classes and words of n tokens and their contexts, common words first."""
    units = np.where(rng.random(n) < 0.4, rng.integers(0, model.classes, n), model.classes + 1 + (model.words * rng.random(n) ** 4).astype(int))
    classes, words = model.split(units)
    return classes, words, *model.contexts(units, np.array([0, n // 2, n]))


def test_noise_follows_the_counts_of_a_parent():
    model, rng = small_model()
    draw = model.noise_inside()
    for parent in range(len(model.entry_starts) - 1):
        inside = slice(*model.entry_starts[parent : parent + 2])
        drawn = draw(rng, np.full(5000, parent)).ravel()
        assert inside.start <= drawn.min() and drawn.max() < inside.stop
        share = model.entry_counts[inside] / model.entry_counts[inside].sum()
        found = np.bincount(drawn - inside.start, minlength=len(share)) / len(drawn)
        assert np.abs(found - share).max() < 0.02


def test_noise_is_drawn_without_bisecting_the_vocabulary():
    """A draw among 400,000 words takes much less time than a search for it."""
    model, rng = small_model(words=400_000)
    draw, totals = model.noise_inside(), np.cumsum(model.entry_counts)
    parents = rng.integers(4, len(model.entry_starts) - 1, 20_000)

    def seconds(run):
        taken = []
        for _ in range(7):
            begin = time.thread_time()
            run()
            taken.append(time.thread_time() - begin)
        return min(taken)

    wanted = [rng.integers(0, totals[-1], 4 * len(parents)) for _ in range(7)]
    assert seconds(lambda: draw(rng, parents)) < 0.7 * seconds(lambda: np.searchsorted(totals, wanted.pop() if len(wanted) > 1 else wanted[0]))


def test_a_step_sums_the_slopes_of_every_meeting():
    """Two batches give what plain sums in double precision give."""
    model, rng = small_model()
    batches = [drawn_tokens(model, rng, 700) for _ in range(2)]
    parameters, entries, met, seen = model.train(model.parameters, model.entry_parameters, iter(batches), 5)
    words, out, near, far, bias = (p.astype(np.float32).astype(float) for p in model.parameters)
    more, inner, shift = (p.astype(float) for p in model.entry_parameters)
    squares, times = [np.ones(len(shift)) for _ in range(3)], np.zeros((2, len(shift)))
    big, noise_rng, totals = [np.full(p.shape, 1e-3) for p in model.parameters], np.random.default_rng(5), np.append(0, np.cumsum(model.entry_counts))
    for target, word, one, two in batches:
        (one, w1), (two, w2) = model.split(one), model.split(two)
        a, b = (words[c] + np.where(w[:, None] >= 0, more[model.nodes + w], 0) for c, w in ((one, w1), (two, w2)))
        p = a @ near + b @ far
        noise = noise_rng.choice(model.classes, lb.NOISE, p=model.share)
        log_noise = np.log(lb.NOISE * model.share)
        g = -1 / (1 + np.exp((p * out[target]).sum(1) + bias[target] - log_noise[target]))
        h = 1 / (1 + np.exp(-(p @ out[noise].T + bias[noise] - log_noise[noise])))
        by_p, by_out, by_bias, by_words = g[:, None] * out[target] + h @ out[noise], np.zeros(out.shape), np.zeros(bias.shape), np.zeros(words.shape)
        for at, slope, slopes in ((target, g, g[:, None] * p), (noise, h.sum(0), h.T @ p)):
            np.add.at(by_out, at, slopes)
            np.add.at(by_bias, at, slope)
        place, entry, parent = model.inside(target, word)
        drawn = noise_rng.random((len(place), lb.WORD_NOISE))
        low, high = (totals[model.entry_starts[parent + i]][:, None] for i in (0, 1))
        drawn = np.searchsorted(totals, low + np.floor(drawn * (high - low)).astype(int), "right") - 1
        index = np.concatenate((entry[None], drawn.T))
        error = 1 / (1 + np.exp(-((inner[index] * p[place]).sum(2) + shift[index] - np.log(lb.WORD_NOISE))))
        error[0] -= 1
        np.add.at(by_p, place, (error[:, :, None] * inner[index]).sum(0))
        by_one, by_two = by_p @ near.T, by_p @ far.T
        np.add.at(by_words, one, by_one)
        np.add.at(by_words, two, by_two)
        by_inner, by_shift, by_more = np.zeros(inner.shape), np.zeros(shift.shape), np.zeros(more.shape)
        np.add.at(by_inner, index, error[:, :, None] * p[place])
        np.add.at(by_shift, index, error)
        np.add.at(times[1], index, 1)
        for w, slopes in ((w1, by_one), (w2, by_two)):
            np.add.at(by_more, model.nodes + w[w >= 0], slopes[w >= 0])
            np.add.at(times[0], model.nodes + w[w >= 0], 1)
        for i, (value, slope) in enumerate(((more, by_more), (inner, by_inner), (shift, by_shift))):
            squares[i] += (slope * slope).reshape(len(slope), -1).mean(1)
            value -= lb.WORD_RATE * slope / np.sqrt(squares[i]).reshape(-1, *[1] * (value.ndim - 1))
        for i, (value, slope) in enumerate(zip((words, out, near, far, bias), (by_words, by_out, a.T @ by_p, b.T @ by_p, by_bias))):
            slope = slope / len(target)
            big[i] += slope * slope
            value -= 0.1 * slope / np.sqrt(big[i])
    assert seen == 1400 and (met == times).all()
    for got, want in zip([*parameters, *entries], [words, out, near, far, bias, more, inner, shift]):
        assert np.allclose(got, want, atol=2e-3)


def test_scores_need_no_certain_size():
    """Long vectors, for which exponentials overflow, and the way without packed keys, against plain sums in double precision."""
    model, rng = small_model(words=300)
    for scale in (1, 40):
        model.entry_parameters = [p * np.float32(scale) for p in model.entry_parameters]
        classes, own, one, two = drawn_tokens(model, rng, 300)
        got = model.log_probabilities(classes, own, one, two)
        words, out, near, far, bias = model.parameters
        (c1, w1), (c2, w2) = model.split(one), model.split(two)
        more, inner, shift = (p.astype(float) for p in model.entry_parameters)
        a, b = (words[c] + np.where(w[:, None] >= 0, more[model.nodes + w], 0) for c, w in ((c1, w1), (c2, w2)))
        p = a @ near + b @ far
        scores = p @ out.T + bias
        want = scores[np.arange(300), classes] - np.logaddexp.reduce(scores, 1)
        for place, entry, parent in zip(*model.inside(classes, own)):
            inside = slice(*model.entry_starts[parent : parent + 2])
            scores = inner[inside] @ p[place] + model.entry_bias[inside] + shift[inside]
            want[place] += scores[entry - inside.start] - np.logaddexp.reduce(scores)
        assert np.isfinite(got).all() and np.allclose(got, want, atol=1e-3, rtol=1e-4)
    values = rng.integers(0, 50, 400)
    for a, b in zip(lb._distinct(values, 50), lb._distinct(values, 2**62)):
        assert (a == b).all()


def test_known_tokens_are_found():
    model, rng = small_model()
    ends = np.array([0, 1, 2**64 - 1], np.uint64)
    tokens = np.concatenate((model.known, model.known + np.uint64(1), ends))
    at, known = model.known_at(tokens)
    assert known.tolist() == np.isin(tokens, model.known).tolist() and (model.known[at[known]] == tokens[known]).all()
    classes, words = model.places_of(tokens, np.full(len(tokens), 300))
    assert (classes[:20] == np.arange(20)).all() and (classes[20:] == 21).all() and (words[: len(model.known)] == model.word_at).all()
    assert (model.places_of(ends, np.array([-1, 5, 9000]))[0] == [23, 23, 22]).all()


def test_parts_that_no_copy_met_stay():
    """An entry met only as a choice sends no context, so that a mean does not set it to zero."""
    rng = np.random.default_rng(2)
    values = [rng.normal(size=(3, lb.WIDTH)), rng.normal(size=(3, lb.WIDTH)), rng.normal(size=3)]
    index, met = np.array([1024, 1030, 2047]), np.array([[0, 2, 0], [1, 0, 3]], float)
    sent = lb._packed(index, met, values)
    mean = lb._mean_entries(pa.chunked_array([pa.array([sent, sent], pa.binary())]))
    (place, times, context), (places, counts, choice) = lb._unpacked(pa.py_buffer(mean))
    assert (place == [6]).all() and (times == [4]).all() and (places == [0, 1023]).all() and (counts == [2, 6]).all()
    assert np.allclose(context, values[0][[1]], atol=2e-3)
    assert np.allclose(choice, np.concatenate((values[1], values[2][:, None]), 1)[[0, 2]], atol=2e-3)
