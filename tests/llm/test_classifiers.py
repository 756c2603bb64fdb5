import zlib

import numpy as np
import pytest

from steploom.llm import mil_quality
from steploom.llm.common import read
from steploom.llm.language import Grams, LangConfig, fit_languages, identify, landmark_model, train_languages
from steploom.llm.mil_quality import FEATURES, MilConfig, fit_mil, passage_features, quality_score, train_quality, within_bound
from steploom.llm.queries import language_id, quality_classifier

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"
QUALITY = MilConfig(sample_per_class=200, epochs=80)
LANGUAGE = LangConfig(landmarks=40, sample=200)


def test_quality_on_held_out_documents(spark):
    got = quality_classifier(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 1000
    rows = got.join(read(spark, SF, "labels"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    for label in (0, 1):
        own = [r.predicted == label for r in rows if r.held_out and r.quality == label]
        assert len(own) > 10 and np.mean(own) > 0.95


def test_language_on_held_out_documents(spark):
    got = language_id(spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == 1000
    rows = got.join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows if r.held_out]) > 0.99


def _spread(text, n):
    return [(text or "") + f" w{i}" for i in range(n)]


def test_quality_edge_cases(spark):
    good, bad = _spread("The quiet river ran on. It was a long day, and warm.", 40), _spread("BUY!! NOW!! $$$ ### | | |", 40)
    docs = spark.createDataFrame(list(enumerate(good + bad)), DOCS)
    marks = [(i, int(i < 40), None) for i in range(80)] + [(None, 1, 0), (3, None, 0), (5, 0, 1), (5, 1, 1), (5, 1, 1)]
    model = train_quality(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), QUALITY)
    texts = [None, "", " ", good[0], bad[0], (good[0] + " ") * 20_000]
    odd = spark.createDataFrame([(i, t, 0.0, "x") for i, t in enumerate(texts)], DOCS + ", score double, label string")
    got = [r.s for r in odd.select("doc_id", quality_score(model)("text").alias("s")).orderBy("doc_id").collect()]
    assert all(0 <= s <= 1 for s in got) and got[0] == got[1] == got[2]
    assert got[3] > 0.5 > got[4] and got[5] == model.scores([texts[5]])[0]


@pytest.mark.parametrize("labels, share", [([], 0.5), ([(0, 1), (2, 1)], 2.5 / 3)])
def test_quality_without_two_classes(spark, labels, share):
    docs = spark.createDataFrame([(0, "a b"), (2, "c")], DOCS)
    labels = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 3 != 1]
    share = (len(labels) + 0.5) / (len(labels) + 1)
    model = train_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"), QUALITY)
    assert model.scores(["x", None]) == pytest.approx([share, share])


def learned_from(spark, monkeypatch, docs, config):
    """Features and passage counts that reach the fit."""
    seen = []
    monkeypatch.setattr(mil_quality, "fit_mil", lambda *given: seen.append(given) or fit_mil(*given))
    marks = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, quality int")
    train_quality(spark.createDataFrame(docs, DOCS), marks, config)
    return seen[0]


def test_all_passages_are_learned_from(spark, monkeypatch):
    texts = {0: "one two three " * 16 * 300 + "!! " * 48 + "four five six " * 16 * 299, 1: "short", 7: "BUY " * 480}
    x, counts, labels, _ = learned_from(spark, monkeypatch, list(texts.items()), MilConfig(epochs=1))
    want, sizes = passage_features(list(texts.values()), 48)
    assert counts.tolist() == sizes.tolist() == [600, 1, 10] and labels.tolist() == [0, 1, 1]
    np.testing.assert_allclose(x, want, rtol=1e-6)


def test_documents_beyond_the_bound_are_left_out_whole(spark, monkeypatch):
    docs = [(i, "word " * 48 * (1 + i % 7)) for i in range(60)]
    x, counts, labels, _ = learned_from(spark, monkeypatch, docs, MilConfig(epochs=1, passages=40))
    assert set(counts) <= set(range(1, 8)) and len(x) == counts.sum()
    assert all(14 <= counts[labels == k].sum() <= 20 for k in (0, 1))
    assert within_bound([(1, 0, 99), (2, 1, 3), (3, 0, 1), (4, 1, 18), (5, 1, 17)], MilConfig(passages=40)) == {1, 2, 5}


def test_no_documents(spark):
    docs = spark.createDataFrame([], DOCS)
    model = train_quality(docs, spark.createDataFrame([], "doc_id long, quality int"), QUALITY)
    assert docs.select(quality_score(model)("text")).collect() == []
    nothing = train_languages(spark.createDataFrame([], DOCS + ", lang string"), LANGUAGE)
    assert nothing.predict(["a", None])[0] == ["und", "und"]


def test_features_by_hand():
    x, counts = passage_features(["Ab ab ab, 12!! é", None, "a b c"], 3)
    row = dict(zip(FEATURES, x[0], strict=True))
    assert counts.tolist() == [2, 1, 1]
    assert row["word_chars"] == pytest.approx(7 / 3) and row["repeated"] == 0 and row["distinct"] == 1
    assert row["upper"] == pytest.approx(1 / 6) and row["comma"] == pytest.approx(1 / 3)
    second = dict(zip(FEATURES, x[1], strict=True))
    assert second["bang"] == 1 and second["single"] == 0.5 and second["other_script"] == 1
    assert not x[2].any() and dict(zip(FEATURES, x[3], strict=True))["single"] == 1


def test_groups_do_not_change_features():
    texts = ["one two three " * n for n in (1, 20_000, 5, 60_000, 0, 3)]
    x, counts = passage_features(texts, 48)
    alone = [passage_features([t], 48) for t in texts]
    assert counts.tolist() == [int(c[0]) for _, c in alone]
    np.testing.assert_allclose(x, np.concatenate([a for a, _ in alone]))


def test_gradient_lowers_the_loss_and_attention_sums_to_one():
    r = np.random.default_rng(1)
    counts = r.integers(1, 6, 60)
    labels = np.repeat([0.0, 1.0], 30)
    x = r.normal(0, 1, (counts.sum(), len(FEATURES)))
    first = np.cumsum(counts) - counts
    x[first, 3] += 4 * labels  # one telling passage in each bag
    model = fit_mil(x, counts, labels, MilConfig(epochs=200))
    f = model.forward((x - model.centre) / model.spread, counts)
    assert (((f["logit"] > 0) == labels).mean()) > 0.95
    np.testing.assert_allclose(np.add.reduceat(f["a"], first), 1)


def test_language_edge_cases(spark):
    words = {"xx": "kala muni toro", "yy": "brst zmrk plvx"}
    rows = [(i, f"{words[k]} {words[k][i % 9:]}", k) for i in range(40) for k in words]
    rows += [(100, None, "xx"), (101, "", "yy"), (None, "kala", "yy"), (102, "kala", None)]
    docs = spark.createDataFrame([(*x, "p") for x in rows], DOCS + ", lang string, lang_pred string")
    model = train_languages(docs, LANGUAGE)
    texts = [None, "", "12 !?", "toro", "ZMRK", "kala " * 200_000, "Ωμέγα", "😀"]
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:7])], DOCS)
    got = odd.select("doc_id", identify(model)("text").alias("p")).orderBy("doc_id").select("p.*").collect()
    assert [r.lang_pred for r in got[:6]] == ["und", "und", "und", "xx", "yy", "xx"]
    assert got[6].lang_pred in words and all(0 <= r.score <= 1 for r in got)
    assert [r.score for r in got[:3]] == [0, 0, 0]


def test_languages_of_a_rare_script(spark):
    """Six languages share 60 letters; two of another script have words of the same lengths, in other letters or another order."""
    latin = [chr(c) for c in [*range(97, 123), *range(0xE0, 0xF7), *range(0xF8, 0x104, 1)] if chr(c).isalpha()][:60]
    rare = {"ka": "კალა მუნი ტორო", "kb": "ბრსთ ზმრკ პლვხ", "kc": "ალაკ ინუმ ოროტ"}
    rows = [(100 * k + i, " ".join("".join(latin[j:] + latin[:j])[k : k + 50] for j in (i, i + 7)), f"l{k}") for k in range(6) for i in range(20)]
    rows += [(1000 + 100 * k + i, f"{t} {t[i % 9 :]}", name) for k, (name, t) in enumerate(rare.items()) for i in range(40)]
    model = train_languages(spark.createDataFrame(rows, DOCS + ", lang string"), LANGUAGE)
    assert model.predict([t[:9] for t in rare.values()])[0] == list(rare)


def test_learning_ignores_row_order(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    a, b = train_languages(docs, LANGUAGE), train_languages(docs.repartition(7), LANGUAGE)
    np.testing.assert_allclose(a.weights, b.weights)


def real_grams(text):
    """Grams of one to three signs as a set of strings: letters, and one gap for all between words."""
    signs = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in signs:
        signs = signs.replace("  ", " ")
    return {signs[i : i + n] for n in (1, 2, 3) for i in range(len(signs) - n + 1)} - {" "}


def brute_languages(landmarks, sample, languages, texts, ridge):
    """Kernel ridge regression over all grams of the sample, with sets and plain loops."""
    names = sorted(set(languages))

    def kernel(a, b):
        return len(a & b) / np.sqrt(len(a) * len(b)) if a and b else 0.0

    marks = [real_grams(t) for t in landmarks]
    known = set().union(*marks)
    values, vectors = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    root = vectors @ np.diag([1 / np.sqrt(v) if v > 1e-6 else 0.0 for v in values]) @ vectors.T
    rows = lambda some: np.array([[len(g & known & m) / np.sqrt(max(len(g), 1) * len(m)) for m in marks] for g in map(real_grams, some)]) @ root
    x, scores = rows(sample), []
    weight = np.array([len(languages) / len(names) / languages.count(k) for k in languages])
    for name in names:
        y = np.array([1.0 if k == name else -1.0 for k in languages])
        left = sum(w * np.outer(r, r) for w, r in zip(weight, x)) + ridge * len(languages) / len(names) * np.eye(len(marks))
        scores.append(rows(texts) @ np.linalg.solve(left, sum(w * r * t for w, r, t in zip(weight, x, y))))
    return names, np.array(scores).T


def test_languages_by_brute_force(spark):
    docs = [r for r in read(spark, "/root/testdata/sf0.001", "documents").collect() if r.text and r.lang]
    config = LangConfig(slot_bits=24)
    texts, languages = [r.text[:150] for r in docs[:60]], [r.lang for r in docs[:60]]
    grams = Grams(config.slot_bits)
    model = landmark_model(grams.presence(texts[:20]), config)
    fit_languages(model, model.kernel_of(grams.presence(texts[:20])), model.kernel(texts), languages)
    asked = [r.text[200:300] for r in docs if len(r.text) > 300][:30] + ["x", "ÄÖ ü"]
    names, want = brute_languages(texts[:20], texts, languages, asked, config.ridge)
    got = model.kernel(asked) @ model.weights
    assert model.languages == names
    # Few grams share one of 2 ** 24 slots.
    np.testing.assert_allclose(got, want, atol=1e-3)
    assert (got.argmax(1) == want.argmax(1)).all()


def test_pieces_do_not_change_grams():
    grams = Grams(12)
    texts = ["", "  ", "ab", "one, two  three -- four", "é" * 9 + "  ,  " + "x" * 9, "a  "]
    want = grams.presence(texts)
    for piece in (1, 2, 3, 5):
        assert (grams.presence(texts, piece) == want).all()


def test_repeated_rows_do_not_change_the_sample(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    again = docs.unionByName(docs).unionByName(docs.where("doc_id % 7 = 0"))
    np.testing.assert_allclose(train_languages(docs, LANGUAGE).weights, train_languages(again, LANGUAGE).weights)


def plain_score(w, bag):
    """The score of one document, passage by passage."""
    k = len(w["score"])
    encoded = [[np.tanh(sum(p[i] * w["encode"][i, j] for i in range(len(p))) + w["encode_0"][j]) for j in range(k)] for p in bag]
    power = []
    for h in encoded:
        total = 0.0
        for m in range(len(w["attend"])):
            signal = np.tanh(sum(h[j] * w["signal"][j, m] for j in range(k)))
            gate = 1 / (1 + np.exp(-sum(h[j] * w["gate"][j, m] for j in range(k))))
            total += signal * gate * w["attend"][m]
        power.append(np.exp(total))
    z = [sum(a * h[j] for a, h in zip(power, encoded)) / sum(power) for j in range(k)]
    return 1 / (1 + np.exp(-(sum(z[j] * w["score"][j] for j in range(k)) + w["score_0"][0])))


def test_quality_scores_by_brute_force(spark):
    docs = [r.text for r in read(spark, "/root/testdata/sf0.001", "documents").limit(40).collect()] + [None, "", "x"]
    x, counts = passage_features(docs, 48)
    labels = np.arange(len(docs)) % 2
    model = fit_mil(x, counts, labels.astype(float), MilConfig(epochs=20))
    bags = np.split((x - model.centre) / model.spread, np.cumsum(counts)[:-1])
    np.testing.assert_allclose(model.scores(docs), [plain_score(model.weights, bag) for bag in bags], rtol=1e-9)


def test_first_step_follows_the_numeric_gradient():
    """Adam's first step is the rate times the sign of the gradient of loss and decay, whatever its size."""
    r = np.random.default_rng(2)
    counts = r.integers(1, 4, 12)
    labels = np.repeat([0.0, 1.0], 6)
    x = r.normal(0, 1, (counts.sum(), len(FEATURES)))
    config = MilConfig(epochs=0, hidden=3, attention=2)
    start, moved = fit_mil(x, counts, labels, config), fit_mil(x, counts, labels, MilConfig(epochs=1, hidden=3, attention=2))
    bags = np.split((x - start.centre) / start.spread, np.cumsum(counts)[:-1])

    def loss():
        p = np.array([plain_score(start.weights, bag) for bag in bags])
        each = np.where(labels == 1, -np.log(p), -np.log(1 - p)) / 12
        return each.sum() + config.decay / 2 * sum((v**2).sum() for v in start.weights.values())

    for name, values in start.weights.items():
        for at in list(np.ndindex(values.shape))[:6]:
            kept, sides = values[at], []
            for side in (1e-5, -1e-5):
                values[at] = kept + side
                sides.append(loss())
            values[at] = kept
            slope = (sides[0] - sides[1]) / 2e-5
            if abs(slope) > 1e-5:
                assert moved.weights[name][at] - kept == pytest.approx(-config.rate * np.sign(slope), rel=1e-2)
