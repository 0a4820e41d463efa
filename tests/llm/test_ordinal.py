import numpy as np

from loadtide.llm import ordinal as O


def test_thresholds_are_ordered_and_grades_are_learned():
    rng = np.random.default_rng(0)
    words = [f"w{k}".encode() for k in range(300)]
    texts, grades = [], []
    for _ in range(1200):
        g = int(rng.integers(4))
        own = [words[k] for k in rng.integers(20, 300, 40)] + [words[k] for k in rng.integers(0, 5, 4)] * 0
        own += [[b"awful"], [b"poor"], [], [b"superb"]][g]
        rng.shuffle(own)
        texts.append(b" ".join(own))
        grades.append(g)
    grades = np.array(grades)
    slots = list(O.features(texts))
    model = O.fit_rows(slots[:800], grades[:800], 4, 3, 1e-4, 150)
    assert (np.diff(model.thresholds) > 0).all()
    s = model.scores(texts[800:])
    guess = (s[:, None] > model.thresholds[None]).sum(axis=1)
    assert (guess == grades[800:]).mean() > 0.9


def test_gradient_by_differences(monkeypatch):
    monkeypatch.setattr(O, "SCREEN", 0.0)
    rng = np.random.default_rng(1)
    slots = [np.unique(rng.integers(0, 6, 3)) for _ in range(60)]
    grades = rng.integers(0, 3, 60)
    model = O.fit_rows(slots, grades, 3, 1, 1e-3, 3000)

    def loss(w, theta):
        s = np.array([w[f].sum() for f in slots])
        cut = np.concatenate(([-np.inf], theta, [np.inf]))
        p = O._sigmoid(s - cut[grades]) - O._sigmoid(s - cut[grades + 1])
        return -np.log(p).mean() + 0.5e-3 * (w**2).sum()

    best = loss(model.weights, model.thresholds)
    for _ in range(200):
        w = model.weights.copy()
        w[:6] += rng.standard_normal(6) * 0.02
        assert loss(w, np.sort(model.thresholds + rng.standard_normal(2) * 0.02)) >= best - 1e-5


def test_held_out_accuracy(spark):
    """Trained on the labels with an even id, measured on the others."""
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = O.grades_of(spark.read.parquet(f"{d}/labels.parquet"))
    model = O.fit(docs, labels.where("doc_id % 2 = 0"), levels=3)
    out = O.grade_documents(model, docs, at_least=2).join(labels.where("doc_id % 2 = 1"), "doc_id")
    got = out.groupBy("grade").agg({"accepted": "count", "doc_id": "count"}).collect()
    rows = out.select("grade", "accepted").collect()
    good = [r.accepted for r in rows if r.grade == 2]
    poor = [r.accepted for r in rows if r.grade == 0]
    toxic = [r.accepted for r in rows if r.grade == 1]
    assert len(got) == 3 and np.mean(good) > 0.98 and np.mean(poor) < 0.1 and np.mean(toxic) < 0.7


def test_defined_cases(spark):
    long = "good words " * 60_000
    rows = [(1, None), (2, ""), (3, " .,! "), (4, "plain text"), (4, "plain text"), (None, "other"), (5, long)]
    docs = spark.createDataFrame([(*r, 0.5, "no", 7) for r in rows], "doc_id long, text string, expected_grade double, accepted string, _score int")
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = O.fit(docs, none, levels=3)
    out = O.grade_documents(model, docs, at_least=2)
    got = [(r.doc_id, r.expected_grade, r.accepted) for r in out.collect()]
    assert len(got) == 7 and all(e == 0 and not a for d, e, a in got if d in (1, 2, 3))
    assert len({r for r in got if r[0] == 4}) == 1
    one = spark.createDataFrame([(4, 2), (None, 1), (9, 0), (4, None)], "doc_id long, grade int")
    model = O.fit(docs, one, levels=3)
    assert not model.weights.any() and model.thresholds[0] < model.thresholds[1]
    assert O.grade_documents(model, docs.limit(0), 2).count() == 0
    graded = O.grades_of(spark.createDataFrame([(1, 1, None), (2, None, 1), (3, 0, 1), (4, 1, 1)], "doc_id long, quality int, toxic int"))
    assert [r.grade for r in graded.orderBy("doc_id").collect()] == [2, None, 0, 1]


def test_features_see_case_and_words():
    a, b, c, d = O.features([b"Some words here", b"some WORDS here", b"", b"caf\xc3\xa9 \xff"])
    assert not len(c) and len(d) and set(a) != set(b) and len(set(a) & set(b)) >= 9


def _graded(rng, counts):
    """Texts of graded rows, all of like statistics: poor ones hold marks, those of grade 1 hold four of ten words."""
    vocab = [f"w{k}" for k in range(100, 500)]
    cues = [f"{chr(97 + k)}777" for k in range(10)]
    texts, grades = [], []
    for g, c in enumerate(counts):
        for _ in range(c):
            own = [vocab[k] for k in rng.permutation(400)[:60]]
            if g == 1:
                own[:4] = [cues[k] for k in rng.permutation(10)[:4]]
            rng.shuffle(own)
            texts.append((" *** " if g == 0 else " ").join(own).encode())
            grades.append(g)
    return list(O.features(texts)), np.array(grades)


def test_few_labels_and_a_middle_grade_between_equal_sides():
    rng = np.random.default_rng(3)

    def accepted(train, test):
        model = O.fit_rows(*train, 3, 8, 1e-5, 400)
        s = np.array([model.weights[f].sum() for f in test[0]])
        return [np.mean(s[test[1] == g] >= model.thresholds[1]) for g in range(3)]

    test = _graded(rng, (100, 100, 100))
    for counts in ((300, 100, 300), (900, 200, 900)):
        poor, toxic, good = accepted(_graded(rng, counts), test)
        assert poor < 0.05 and toxic < 0.1 and good > 0.95, counts
    poor, _, good = accepted(_graded(rng, (12, 8, 60)), test)
    assert poor < 0.5 and good > 0.9


def test_held_out_middle_grade():
    """As test_held_out_accuracy, without Spark and with narrower bounds."""
    import pyarrow.parquet as pq

    d = "/root/testdata/sf0.1"
    docs = dict(zip(*pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values()))
    labels = pq.read_table(f"{d}/labels.parquet", columns=["doc_id", "quality", "toxic"]).to_pylist()
    rows = [(r["doc_id"], 0 if r["quality"] == 0 else 1 if r["toxic"] == 1 else 2) for r in labels if r["quality"] is not None]
    slots = dict(zip([i for i, _ in rows], O.features([(docs[i] or "").encode() for i, _ in rows])))
    even, odd = ([r for r in rows if r[0] % 2 == k] for k in (0, 1))
    model = O.fit_rows([slots[i] for i, _ in even], np.array([g for _, g in even]), 3, 8, 1e-5, 400)
    share = [np.mean([model.weights[slots[i]].sum() >= model.thresholds[1] for i, g in odd if g == k]) for k in range(3)]
    assert share[2] > 0.99 and share[0] < 0.1 and share[1] < 0.3, share


def test_repeated_labels_and_documents_count_once(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of some") for i in range(20)], "doc_id long, text string")
    rows = [(i, 0 if i < 5 else 1 if i < 9 else 2) for i in range(20)]
    once = O.fit(docs, spark.createDataFrame(rows, "doc_id long, grade int"), 3, max_rows=20)
    again = O.fit(docs.union(docs), spark.createDataFrame(rows * 10, "doc_id long, grade int"), 3, max_rows=20)
    assert np.array_equal(once.thresholds, again.thresholds) and np.array_equal(once.weights, again.weights)


def test_extra_columns_of_any_name_keep_their_values(spark):
    names = ["row", "_score", "score", "grade", "slots", "a.b"]
    rows = [(i, f"some text {i}", *(f"{c}{i}" for c in names)) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", `{c}` string" for c in names))
    model = O.OrdinalModel(np.zeros(O.SLOTS), np.array([-1.0, 1.0]))
    out = O.grade_documents(model, df, at_least=2)
    assert out.columns == [*df.columns, "expected_grade", "tail_probability", "accepted"]
    assert sorted(tuple(r)[:-3] for r in out.collect()) == rows
