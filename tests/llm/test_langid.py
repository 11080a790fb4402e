"""Language ID on held-out documents, and the mixture on made-up proportions."""

import math

import numpy as np

from cohortwise.llm import langid, queries

FOLDER = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    got = queries.op7_langid(spark, FOLDER).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").drop("text").toPandas().set_index("doc_id")
    both = got.join(docs)
    assert len(got) == len(docs) and both.score.between(0, 1).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.99


def test_mixture_proportions():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(300), 3).T
    counts = rng.multinomial(20_000, p @ [0.2, 0.0, 0.8]).astype(float)
    weights, _ = langid.proportions(p, counts)
    assert np.abs(weights - [0.2, 0, 0.8]).max() < 0.03


def plain_infer(text, names, table):
    """The rules of ``infer`` with loops: all languages, mixtures by EM, penalised choice."""
    grams = {}
    for g in langid.trigrams(text).tolist():
        grams[g] = grams.get(g, 0) + 1
    total = sum(grams.values())

    def mixture(chosen):
        w = [1 / len(chosen)] * len(chosen)
        likes = {g: [math.exp(float(table[k, g]) - max(float(x) for x in table[:, g])) for k in chosen] for g in grams}
        for _ in range(langid.ROUNDS if len(chosen) > 1 else 0):
            new = [0.0] * len(w)
            for g, n in grams.items():
                whole = sum(a * b for a, b in zip(w, likes[g]))
                for k in range(len(w)):
                    new[k] += n * w[k] * likes[g][k] / whole / total
            far, w = max(abs(a - b) for a, b in zip(w, new)), new
            if far < 1e-4:
                break
        return w, sum(n * math.log(sum(a * b for a, b in zip(w, likes[g]))) for g, n in grams.items())

    order = sorted(range(len(names)), key=lambda k: (-mixture(list(range(len(names))))[0][k], k))
    best = None
    for size in range(1, len(order) + 1):
        w, like = mixture(order[:size])
        value = like / langid.OVERLAP - size * (0.5 * math.log(total / langid.OVERLAP + 1) + 1)
        if best is not None and value <= best[0]:
            break
        best = value, max(zip(w, (-k for k in order[:size])))
    return names[-best[1][1]], min(1.0, best[1][0])


def test_against_plain_loops_with_twelve_languages():
    rng = np.random.default_rng(3)
    names = [f"l{i:02d}" for i in range(12)]
    # Ten languages share the alphabet of the first ten letters, two have letters of their own.
    letters = [list("abcdefghij")] * 10 + [list("klmnop"), list("qrstuv")]
    weights = [rng.dirichlet(np.ones(len(x))) for x in letters]
    words = lambda k, n: " ".join("".join(rng.choice(letters[k], 5, p=weights[k])) for _ in range(n))
    table = np.full((12, langid.BUCKETS), langid.SMOOTHING)
    for k in range(12):
        table[k] += np.bincount(langid.trigrams(words(k, 3000)), minlength=langid.BUCKETS)
    table = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    for mixed in (words(0, 200), words(3, 150) + " " + words(11, 40), words(10, 90) + " " + words(2, 60), words(5, 1)):
        name, share = langid.infer(mixed, names, table)
        want, part = plain_infer(mixed, names, table)
        assert name == want and abs(share - part) < 1e-6
    text = words(3, 150) + " " + words(11, 40)
    counts = np.bincount(langid.trigrams(text), minlength=langid.BUCKETS)
    alone = np.argsort(-(table @ counts)).tolist()
    assert alone.index(11) >= 8
    assert langid.infer(text, names, table)[1] < 0.9  # the ninth or later one takes its share


def test_set_of_languages(spark):
    names, table = langid.learn(
        spark.read.parquet(f"{FOLDER}/documents.parquet").limit(2000), "lang", "text"
    )
    docs = {r.lang: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300).collect()
            if 2000 < len(r.text) < 6000}
    assert set(docs) == set(names)
    name, share = langid.infer(docs["de"][:1500] + docs["fr"][:500], names, table)
    assert name == "de" and 0.6 < share < 0.9


def test_odd_rows(spark):
    rows = [(1, "the cat sat", "en", 0), (2, "le chat assis", "fr", 0), (3, "le chat", None, 0), (None, "the", "en", 0),
            (5, None, "en", 0), (6, "", "fr", 0), (7, "12 34 !", "fr", 0), (7, "12 34 !", "fr", 0), (8, "中文", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (5, 6, 7)} == {"und"} and by[8].lang_pred in {"en", "fr"}
    assert all(0 <= r.score <= 1 for r in got)
    alone = langid.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).where("doc_id = 8")).collect()
    assert len(alone) == 1


def test_nothing_learnt_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(docs).collect()] == [("und", 0.0)]
    assert langid.identify(docs.limit(0)).count() == 0
