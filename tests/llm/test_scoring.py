"""Language, toxicity and quality: models by brute force, held-out accuracy, odd rows."""

import numpy as np
import public_tokenizers
import pytest

from paylake.llm import language, letters, linear, quality, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def larger(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def held_out(got, truth, column):
    rows = [(r, truth[r.doc_id]) for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert len(rows) > 30
    return np.mean([getattr(r, column) == t for r, t in rows])


def segmentations(word):
    if not word:
        yield []
    for n in range(1, min(language.PIECE, len(word)) + 1):
        for rest in segmentations(word[n:]):
            yield [word[:n], *rest]


def test_forward_pass_sums_all_segmentations():
    table, rng = language._table(PIECES), np.random.default_rng(0)
    p = rng.random((table.size, 3)) * 0.01
    p[-1] = 0
    found = ["straße", "the", "été", "a", "understand", "zzqxj", "ñandú"]
    w = next(letters.words(found))
    begin = np.concatenate([[0], w.stops[:-1] + 1])

    def number(piece):
        return int(table.numbers(np.array([letters.hash_of(piece)], np.uint64), len(piece) == 1)[0])

    want = [np.log(sum(np.prod(p[[number(x) for x in s]], axis=0) for s in segmentations(word))) for word in found]
    assert np.allclose(language.word_scores(w, begin, w.stops, table, p), want)


def test_expected_uses_are_those_of_all_segmentations():
    table, rng = language._table(PIECES), np.random.default_rng(1)
    p = rng.random(table.size) * 0.01
    p[-1] = 0
    w = next(letters.words(["then", "at"]))
    begin = np.concatenate([[0], w.stops[:-1] + 1])
    got = language._expected(w, begin, w.stops, np.array([3.0, 2.0]), table, p)
    want = np.zeros(table.size)
    for word, n in (("then", 3), ("at", 2)):
        ways = [[int(table.numbers(np.array([letters.hash_of(x)], np.uint64), len(x) == 1)[0]) for x in s] for s in segmentations(word)]
        chance = np.array([np.prod(p[s]) for s in ways])
        for s, c in zip(ways, chance / chance.sum()):
            np.add.at(want, s, n * c)
    want[-1] = 0
    assert np.allclose(got, want)


def test_pieces_of_any_length_count():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pieces = {model.id_to_piece(i).replace("▁", "").lower() for i in range(model.get_piece_size())}
    longest = max((p for p in pieces if p.isalpha()), key=len)
    table, w = language._table(PIECES), next(letters.words([longest]))
    piece = table.numbers(w.hashes(w.begin, w.stop), False)
    p = np.zeros((table.size, 1))
    p[piece] = 0.25
    assert len(longest) > 8 and piece[0] != table.size - 1
    assert np.isclose(language.word_scores(w, w.begin, w.stop, table, p)[0, 0], np.log(0.25))


def test_long_runs_of_a_script_no_language_has(spark):
    pairs = [("en", "the cat and the dog are in the house with this child"), ("de", "die katze und der hund sind mit dem kind in dem haus")]
    train = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(pairs * 4)], "doc_id bigint, text string, lang string")
    langs, p = language.learn(spark, train, PIECES)
    run = "".join(chr(0x4E00 + 7 * i) for i in range(300))
    texts = [run, run[:48], "the dog and this child " + run, run + " der hund und die katze"]
    got = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), langs, p, PIECES).collect()
    by_id = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 for r in got)
    assert by_id[2].lang_pred == "en" and by_id[3].lang_pred == "de"


def test_languages_of_documents_not_learned_from(spark, larger):
    documents, _ = larger
    truth = {r.doc_id: r.lang for r in documents.collect()}
    got = language.held_out_identification(spark, documents, PIECES).collect()
    assert len(got) == len(truth) and held_out(got, truth, "lang_pred") >= 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows(spark, odd, empty):
    got = language.held_out_identification(spark, odd, PIECES).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r.lang_pred for r in got}
    assert [by_id[i] for i in (0, 1, 2, 7)] == ["und"] * 4 and by_id[3] in ("en", "de")
    assert language.held_out_identification(spark, empty, PIECES).count() == 0
    assert {r.lang_pred for r in language.held_out_identification(spark, odd.withColumn("lang", odd["source"].substr(9, 1)).limit(5), PIECES).collect()} <= {"und", ""}


def test_toxicity_of_documents_not_learned_from(spark, larger):
    documents, labels = larger
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.held_out_toxicity(spark, documents, labels).collect()
    assert held_out(got, truth, "predicted") >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_toxicity_of_odd_rows(spark, odd, empty, larger):
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 1), (3, 1, 0), (4, 0, None), (None, 1, 1), (5, None, 7), (9, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert toxicity.held_out_toxicity(spark, odd, labels).count() == odd.count()
    assert toxicity.held_out_toxicity(spark, odd, labels.limit(0)).where("score between 0 and 1").count() == odd.count()
    assert toxicity.held_out_toxicity(spark, empty, labels).count() == 0


def test_label_model_weighs_voters_that_repeat_each_other():
    rng = np.random.default_rng(2)
    truth = rng.random(4_000) < 0.3
    fires = np.stack([rng.random(4_000) < np.where(truth, 0.6, 0.05) for _ in range(6)] + [rng.random(4_000) < 0.3], 1)
    given = np.where(rng.random(4_000) < 0.1, ~truth, truth).astype(int)
    q = toxicity.label_model(fires, given, np.ones(4_000))
    assert ((q >= 0.5) == truth).mean() >= (given == truth).mean()
    again = toxicity.label_model(np.hstack([fires, np.repeat(fires[:, -1:], 30, 1)]), given, np.ones(4_000))
    assert ((again >= 0.5) == (q >= 0.5)).mean() > 0.95


def test_quality_of_documents_not_learned_from(spark, larger):
    documents, labels = larger
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.held_out_quality(spark, documents, labels).collect()
    assert len(got) == len({r.doc_id for r in got}) and held_out(got, truth, "predicted") >= 0.93


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, 0, 0), (5, 9, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.held_out_quality(spark, odd, labels)
    assert got.where("score between 0 and 1").count() == odd.count()
    assert quality.held_out_quality(spark, odd, labels.limit(0)).where("predicted = 1").count() == odd.count()
    assert quality.held_out_quality(spark, empty, labels).count() == 0
    scored = quality.score(odd.drop("lang", "n_chars").withColumn("quality", odd["source"]), None)
    assert scored.columns[-1] == "quality" and set(odd.columns) - {"lang", "n_chars"} <= set(scored.columns)


def made(n, seed):
    """Labels, features in which both views tell something, and their codes."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n).astype(float)
    x = rng.normal(size=(n, len(quality.CONTENT) + len(quality.LAYOUT))) + y[:, None] * 1.2
    coding = quality.Coding(quality._edges(x, y))
    return y, x, coding, coding.codes(x, [None] * n, ["a"] * n)


def test_views_teach_each_other():
    """Few labels, many unlabelled rows: pseudo-labels reach the other view."""
    y, x, coding, codes = made(3_000, 4)
    few, rest = [c[:150] for c in codes], [c[200:] for c in codes]
    alone = quality.teach(coding, few, y[:150], lambda of, sizes: [np.zeros(n) for n in sizes])
    taught = quality.teach(coding, few, y[:150], lambda of, sizes: of(rest))
    model = quality.finished(coding, taught, [c[:200] for c in codes], y[:200])
    both, content, page = (((s >= 0.5) == y)[200:].mean() for s in model.scores(x, [None] * 3_000, ["a"] * 3_000))
    plain = [((quality.odds(c, w) > 0) == y)[200:].mean() for c, w in zip(codes, alone)]
    assert both >= max(content, page) - 0.02 and both > 0.8 and content + page > sum(plain) - 0.01
    assert any(np.abs(a - b).max() > 0.05 for a, b in zip(alone, taught))


def test_sums_over_a_table_are_those_over_all_rows(spark):
    """No unlabelled document is left out of a round, however many there are: brute force over 20,000."""
    y, _, coding, codes = made(20_000, 6)
    rng = np.random.default_rng(7)
    weights = [rng.normal(size=sum(w) + 1) for w in coding.widths()]
    rows = spark.createDataFrame(list(zip(codes[0].tolist(), codes[1].tolist())), "content array<int>, page array<int>").repartition(7)
    gather = quality._gatherer(rows)
    for got, want in zip(gather(quality._how_sure(weights), [quality.STEPS_WIDE] * 2), quality._how_sure(weights)(codes)):
        assert np.array_equal(got, want) and want.sum() == 20_000
    slope = quality._slopes(weights, weights, [1.0, 2.0])
    for v, (got, want) in enumerate(zip(gather(slope, list(map(len, weights))), slope(codes))):
        assert np.allclose(got, want)
        said = quality.odds(codes[1 - v], weights[1 - v])
        brute = np.zeros(len(weights[v]))
        for i in np.flatnonzero(np.abs(said) >= [1.0, 2.0][1 - v]):
            off = linear.sigmoid(quality.odds(codes[v][i:i + 1], weights[v]))[0] - (said[i] > 0)
            brute[codes[v][i]] += off
            brute[-1] += off
        assert np.allclose(got, brute)


def test_documents_without_a_label_change_the_weights(spark, larger):
    documents, labels = larger
    some = labels.where("doc_id % 3 > 0")
    one = quality.learn(documents, some)
    other = quality.learn(documents.join(some.select("doc_id"), "doc_id"), some)
    assert one.coding.edges[0].tolist() == other.coding.edges[0].tolist()
    assert any(np.abs(a - b).max() > 1e-3 for a, b in zip(one.weights, other.weights))


def test_logistic_regression():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(5_000, 2))
    y = (rng.random(5_000) < linear.sigmoid(x @ [2.0, -1.0] + 0.5)).astype(float)
    assert np.allclose(linear.fit(x, y), [2.0, -1.0, 0.5], atol=0.25)
