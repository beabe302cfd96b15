import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import licenses, quality, token_counts, toxicity
from ledgerloom.llm.queries import vocabulary_path

TEXTS = "doc_id long, text string, n_tokens string, score string, hits string, label string, _id string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in rows], TEXTS)


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.load_vocabulary(vocabulary_path())


def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


PIECES = [
    "a", "s", "t", "re", "ll", "'", "'s", "'ve", " ", "  ", "\n", "\t", "5", "²", "Ⅷ", "é", "中", "😀", "-", "...",
    "<|endoftext|>", "\x1c", "\x85", "́", "​", "　", "Hello", " world", "the", "_", "\r\n",
]


def test_tokens_equal_the_library(vocabulary):
    random.seed(1)
    texts = ["".join(random.choices(PIECES, k=random.randint(0, 25))) for _ in range(4000)]
    texts += ["", None, "x" * 5000, " " * 3000, "ab " * 20_000, "'" * 100]
    found = token_counts.Counter(vocabulary).count(texts)
    expected = [len(e.ids) for e in _library().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert found.tolist() == expected


def test_whole_tokens_are_proven(vocabulary):
    library = _library()
    counter = token_counts.Counter(vocabulary)
    known = [" the", "the", " idiot", "qqqqqqqq"]
    codes = token_counts.code_points("".join(known))
    ends = np.cumsum([len(k) for k in known])
    hashes = counter.hashes.of(codes, np.concatenate([[0], ends[:-1]]), ends)
    whole = [len(library.encode(k, add_special_tokens=False).ids) == 1 for k in known]
    assert counter._known(hashes).tolist() == whole


def test_token_counts_of_a_table(spark):
    rows = [(1, None), (2, ""), (3, "the <|endoftext|> end"), (3, "the <|endoftext|> end"), (None, "é"), (4, "word " * 1024), (5, "word " * 1025)]
    found = sorted(token_counts.token_counts(_docs(spark, rows), vocabulary_path()).collect(), key=repr)
    library = _library()
    expected = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 1024))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert token_counts.token_counts(_docs(spark, []), vocabulary_path()).count() == 0


def _common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_alignment_is_valid_and_near_the_longest_common_subsequence():
    random.seed(2)
    template = licenses.words_of(licenses.TEMPLATES["MIT-text"])
    for _ in range(30):
        text = [w for w in template if random.random() > 0.05]
        for _ in range(3):
            text.insert(random.randrange(len(text)), random.choice(["foo", "the", "software"]))
        pairs = licenses.align(text, template)
        assert all(text[a] == template[b] for a, b in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) >= 0.95 * _common(text, template)


def test_rising_is_longest():
    random.seed(3)
    for _ in range(50):
        values = random.sample(range(30), 8)
        found = [values[i] for i in licenses.rising(values)]
        assert found == sorted(found)
        best = max(
            (len(s) for m in range(256) if (s := [v for i, v in enumerate(values) if m >> i & 1]) == sorted(s)),
        )
        assert len(found) == best


def test_licenses_are_found(spark):
    prose = "anble the of under wh and " * 300
    rows = [
        (1, prose + "\nLicensed under the Apache License, Version 2.0.\n" + prose),
        (2, "Released under the MIT License.\n" + prose + "Licensed under CC BY-NC 4.0."),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, licenses.TEMPLATES["MIT-text"].replace("free of charge", "free of any charge")),
        (5, "the MIT people released the other license"), (6, None), (7, ""), (8, " \n"), (8, " \n"),
    ]
    found = sorted((r.doc_id, [h.template for h in r.hits]) for r in licenses.scan(_docs(spark, rows)).collect())
    assert found == [
        (1, ["Apache-2.0"]), (2, ["MIT", "CC-BY-NC-4.0"]), (3, ["GPL-3.0"]), (4, ["MIT-text"]), (5, []), (6, []), (7, []), (8, []), (8, []),
    ]
    assert licenses.scan(_docs(spark, [])).count() == 0


def test_pairs_in_linear_time():
    rng = np.random.default_rng(1)
    machine = quality.Machine(np.zeros((1, 1)), 0.3, rng.normal(size=9), rng.normal(size=(9, 3)))
    index, value = np.array([0, 2, 5, 8]), rng.normal(size=4)
    pairs = sum(
        machine.factors[index[i]] @ machine.factors[index[j]] * value[i] * value[j] for i in range(4) for j in range(i)
    )
    z = 0.3 + machine.linear[index] @ value + pairs
    assert abs(machine.score(index, value) - 1 / (1 + np.exp(-z))) < 1e-12


def _accuracy(spark, found, labels, label):
    rows = found.filter("held_out").join(labels.select("doc_id", label).filter(F.col(label).isNotNull()), "doc_id").collect()
    return sum(r.predicted == r[label] for r in rows) / len(rows), rows


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.classify(docs, labels)
    assert found.count() == docs.count()
    share, rows = _accuracy(spark, found, labels, "quality")
    assert share > 0.95 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (4, "word"), (None, "x y"), (5, "!!! ??? \U0001f600 ퟿"), (6, "a " * 50_000), (7, "z" * 100_000)]


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_stand_edge_cases(spark, module, label):
    docs = _docs(spark, EDGES)
    some = [(1, None, None), (4, 1, 1), (5, 0, 0), (99, 1, 1), (None, 1, 0), (3, 0, 1)]
    for rows in (some, []):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        found = module.classify(docs, labels).collect()
        assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
        assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert module.classify(_docs(spark, []), labels).count() == 0


def test_quality_filter_keeps_columns(spark):
    docs = _docs(spark, EDGES)
    labels = spark.createDataFrame([(4, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_windows_cover_all_words():
    for count in (0, 1, 31, 32, 33, 48, 49, 1000):
        cut = toxicity.windows(np.arange(count))
        assert set(cut[cut >= 0].tolist()) == set(range(count))
        assert all((a[toxicity.STRIDE :][b[: -toxicity.STRIDE] >= 0] == b[: -toxicity.STRIDE][b[: -toxicity.STRIDE] >= 0]).all() for a, b in zip(cut, cut[1:]))


def test_gradients():
    params = {k: v.astype(np.float64) for k, v in toxicity.initial(1).items()}
    known = toxicity.Words()
    index = toxicity.windows(toxicity.ids_of("some words of a text that is here twice or so " * 7, known))
    features = toxicity.word_features(list(known))
    seen = np.random.default_rng(1).normal(size=(len(known), toxicity.EVIDENCE))
    labels = np.arange(len(index)) % 2.0

    def loss():
        z = toxicity.logits(params, toxicity.inputs(params, features, seen) @ params["in"] + params["bias"], index)
        return np.mean(np.log1p(np.exp(z)) - labels * z)

    for name, grad in toxicity.gradients(params, features, seen, index, labels).items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        held = params[name][at]
        params[name][at] = held + 1e-3
        up = loss()
        params[name][at] = held - 1e-3
        down = loss()
        params[name][at] = held
        assert abs(grad[at] - (up - down) / 2e-3) < 1e-4 * max(1, abs(grad[at]))


def test_toxicity_learns_words_and_their_forms():
    random.seed(5)
    plain = ["tion", "ble", "ing", "ont", "erha", "the", "of"]

    def text(bad):
        words = [random.choice(plain) + random.choice(plain) for _ in range(random.randint(20, 90))]
        for _ in range(3 * bad):
            words.insert(random.randrange(len(words)), random.choice(["moron", "vequ" + random.choice(plain)]))
        return " ".join(words)

    rows = [(text(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    params = toxicity.train(rows[:300])
    scores = toxicity.Scorer(params).score([t for t, _ in rows[300:]])
    assert np.mean((scores >= 0.3) == np.array([y == 1 for _, y in rows[300:]])) > 0.95
