"""Token links, phrases of test texts and vector codes, against brute force."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import orchard, positional_index, token_counts, token_links

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  two  spaces ", "<|endoftext|> <s> </s>", "▁mark", "nul\x00byte", "don't  \n\n 12½", "ᲉꟋ", "日本語のテキスト", "🙂🙂 ok", "<0x41>", "　wide"]


@pytest.fixture(scope="module")
def encoder():
    return token_links.Encoder(token_links.load_tokenizers(JSON, MODEL))


@pytest.fixture(scope="module")
def texts(spark, folder):
    return [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()] + ODD


def _plain_links(text, encoder, library, pieces):
    """(n_a, n_b, links, groups) from the libraries' own ids, by walking both sides."""
    if not text:
        return 0, 0, [], ""
    a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
    bytes_a, bytes_b = [encoder.bytes_a[i] for i in a], [encoder.bytes_b[i] for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return 0, 0, [], ""
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    links, groups, i, j = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
        links.append((a[x - 1], b[y - 1]))
        i, j = x, y
    return len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def test_classes_of_characters_are_the_librarys():
    library = Tokenizer.from_file(JSON)
    counter = token_counts.Counter(token_counts.load_vocabulary(JSON))
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or c % 97 == 0 or 0xE0000 <= c < 0xE0200)]
    for shape in ("a{}b", " {}1 {} ", "{}{}"):
        asked = [" ".join(shape.replace("{}", chr(c)) for c in codes[k : k + 50]) for k in range(0, len(codes), 50)]
        expected = [len(e.ids) for e in library.encode_batch(asked, add_special_tokens=False)]
        assert counter.count(asked).tolist() == expected


def test_links_match_the_libraries(spark, encoder, texts):
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = [_plain_links(t, encoder, library, pieces) for t in texts]
    counts, best = {}, {}
    for _, _, links, _ in expected:
        for pair in links:
            counts[pair] = counts.get(pair, 0) + 1
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    rows = [(at, text, "x", 1, "x") for at, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, links string, n_a int, pair string").repartition(3)
    found = {r.doc_id: r for r in token_links.aligned_tokens(docs, JSON, MODEL).collect()}
    assert len(found) == len(texts)
    for at, (n_a, n_b, links, digest) in enumerate(expected):
        r = found[at]
        assert (r.n_a, r.n_b, r.n_links, r.n_groups, r.groups_sha256) == (n_a, n_b, len(links), len(links), digest)
        assert r.n_best == sum(counts[p] == best[p[1]] for p in links)
        assert r.count_sum == sum(counts[p] for p in links)


def test_links_of_nothing(spark):
    assert token_links.aligned_tokens(spark.createDataFrame([], "doc_id long, text string"), JSON, MODEL).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_products_match_dense_ones(seed, monkeypatch):
    monkeypatch.setattr(token_links, "PRODUCTS", 50)
    rng = np.random.default_rng(seed)
    left, right = (rng.integers(0, 3, size=s) * (rng.random(s) < 0.3) for s in ((17, 23), (23, 11)))

    def rows(dense):
        at = [np.flatnonzero(r) for r in dense]
        return token_links.Rows(
            np.concatenate([[0], np.cumsum([len(x) for x in at])]), np.concatenate(at), np.concatenate([r[x] for r, x in zip(dense, at)]), dense.shape[1]
        )

    def dense(sparse):
        out = np.zeros((len(sparse.start) - 1, sparse.width), dtype=np.int64)
        out[sparse.entries()] = sparse.values
        return out

    assert (dense(token_links.product(rows(left), rows(right))) == left @ right).all()
    assert (dense(rows(left).transposed()) == left.T).all()


def test_alignment_of_random_cuts():
    rng = np.random.default_rng(5)
    for _ in range(20):
        size = int(rng.integers(1, 60))
        cuts = [np.sort(np.append(rng.choice(size - 1, rng.integers(0, size), replace=True) + 1 if size > 1 else [], size)) for _ in range(2)]
        sizes = [np.diff(np.unique(c.astype(int)), prepend=0) for c in cuts]
        found = token_links.align(*sizes)
        spans = [[set(range(e - s, e)) for s, e in zip(x, np.cumsum(x))] for x in sizes]
        shared = {(i, j): len(a & b) for i, a in enumerate(spans[0]) for j, b in enumerate(spans[1]) if a & b}
        assert dict(zip(zip(*(x.tolist() for x in found.overlaps.entries())), found.overlaps.values.tolist())) == shared
        groups = {
            (i, j) for i, a in enumerate(spans[0]) for j, b in enumerate(spans[1]) if sum(e <= min(a) for e in found.ends) == sum(e <= min(b) for e in found.ends)
        }
        assert set(zip(*(x.tolist() for x in found.group_links().entries()))) == groups


# phrases

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _words(text):
    return [w.decode() for w in WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))]


def _hits(docs, items):
    grams = {}
    for item, text in items:
        words = _words(text)
        width = min(10, len(words))
        for i in range(len(words) - width + 1 if width else 0):
            grams.setdefault(tuple(words[i : i + width]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, hit, found = _words(text), set(), set()
        for width in {len(g) for g in grams}:
            for i in range(len(words) - width + 1):
                names = grams.get(tuple(words[i : i + width]))
                if names:
                    hit.update(range(i, i + width))
                    found |= names
        out.append((doc, len(words), len(hit), sorted(found)))
    return sorted(out, key=repr)


def _corpus():
    random.seed(4)
    word = lambda: random.choice(["the", "of", "Ärger", "x1", "É", "k"]) if random.random() < 0.6 else f"w{random.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(random.choice([1, 3, 9, 10, 11, 35])))) for i in range(20)]
    items += [(100, "the " * 40), (101, "the " * 12), (102, None), (103, "!! ..."), (None, items[3][1]), (5, "same id twice"), (5, "x1 x1 x1 of of")]
    docs = [(i, " ".join(word() for _ in range(random.randrange(120)))) for i in range(60)]
    for i, (_, text) in enumerate(items[:20]):  # whole items, cut ones and one over the edge of two documents
        words = (text or "").split()
        docs.append((200 + i, f"before {text}, AFTER {' '.join(words[1:])} of"))
        docs += [(300 + i, " ".join(words[: len(words) // 2])), (301 + i, " ".join(words[len(words) // 2 :]))]
    return docs + [(400, None), (401, ""), (402, " \n"), (None, items[2][1]), (403, "the " * 3000), (403, "the " * 3000)], items


@pytest.mark.parametrize("bounds", [{}, {"shard_words": 150, "block_words": 40, "vocabulary_terms": 0}])
def test_contamination_matches_brute_force(spark, bounds):
    docs, items = _corpus()
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, term string, row int").repartition(4)
    tests = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")
    found = positional_index.contamination(table, tests, **bounds).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found), key=repr) == _hits(docs, items)


def test_long_items_are_cut(spark, monkeypatch):
    monkeypatch.setattr(positional_index, "CANDIDATES", 30)
    docs, items = _corpus()
    long = " ".join(t for _, t in docs if t)[:6000]
    docs, items = [(1, long), (2, long[1000:3000])], [(7, long), (8, long[2000:2500])]
    segments = positional_index.test_segments(spark.createDataFrame(items, "item_id long, text string"), segment_words=15)
    index = positional_index.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    schema = "row bigint, spans array<struct<begin:bigint,end:bigint>>, items array<string>"
    found = positional_index._searched(index, segments, positional_index._contaminated, schema, "t", 400)
    rows = {}
    for r in found.collect():
        rows.setdefault(r.row, set()).update(p for s in r.spans for p in range(s.begin, s.end))
    assert sorted(len(x) for x in rows.values()) == sorted(h for _, _, h, _ in _hits(docs, items))


def test_proximity_matches(spark):
    docs, items = _corpus()
    items = [i for i in items if i[1]][:12]
    reach = 14
    found = positional_index.matches(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), reach=reach
    )
    found = sorted((r.doc_id, r.item, p) for r in found.filter("doc_id < 400").collect() for p in range(r.begin, r.end))
    frequency = {}
    for _, text in docs:
        for w in _words(text):
            frequency[w] = frequency.get(w, 0) + 1
    expected = set()
    for item, text in items:
        words = _words(text)
        width = min(10, len(words))
        for i in range(len(words) - width + 1):
            window = words[i : i + width]
            if not all(w in frequency for w in window):
                continue
            rarest = min(window, key=lambda w: frequency[w])
            for doc, other in docs:
                if doc is None or doc >= 400:
                    continue
                seen = _words(other)
                expected |= {
                    (doc, str(item), p) for p, w in enumerate(seen)
                    if w == rarest and set(window) <= set(seen[max(0, p - reach) : p + reach + 1])
                }
    assert found == sorted(expected)


def test_contamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in positional_index.contamination(docs, items).collect()] == [(1, 2, 0, [])]
    assert positional_index.contamination(docs.limit(0), items).collect() == []


# vector codes


def _codes(rows, parts=4, entries=256, rounds=4):
    """(code, error) of each row and the codebooks, with every distance computed."""
    whole = np.floor(np.asarray([v for _, v, _ in rows], dtype=float) * 1024).astype(np.int64)
    width = whole.shape[1] // parts
    cut = [whole[:, p * width : (p + 1) * width] for p in range(parts)]
    named = [at for at, r in enumerate(rows) if r[0] is not None]
    first = sorted(named, key=lambda at: (rows[at][0], whole[at].astype("<i8").tobytes()))[:entries]
    books = [x[first].copy() for x in cut]

    def nearest(x, book):
        gaps = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        return gaps.argmin(axis=1), gaps.min(axis=1)

    for _ in range(rounds):
        for x, book in zip(cut, books):
            own, _ = nearest(x, book)
            for entry in set(own.tolist()):
                book[entry] = x[own == entry].sum(axis=0) // (own == entry).sum()
    found = [nearest(x, book) for x, book in zip(cut, books)]
    codes = ["".join(f"{own[at]:02x}" for own, _ in found) for at in range(len(rows))]
    return codes, sum(gap for _, gap in found).tolist(), orchard.codebooks_digest(books)


@pytest.mark.parametrize("rows", [40, 700])
def test_codes_match_brute_force(spark, rows):
    rng = np.random.default_rng(rows)
    made = [(int(i), (rng.integers(-6, 7, size=8) / 8).tolist(), int(i % 3) if i % 5 else None) for i in range(rows)]
    made += [made[3], made[3], (None, [0.5] * 8, 1), (5, [0.25] * 8, None)]
    bad = [(900, None, 1), (901, [], 1), (902, [1.0, None] * 4, 1), (903, [float("nan")] * 8, 2), (904, [float("inf")] * 8, 2), (905, [1.0] * 12, 0)]
    table = spark.createDataFrame([(*r, "x", 1) for r in made + bad], "vec_id long, embedding array<double>, label int, code string, id int").repartition(3)
    codes, errors, digest = _codes(made)
    sums = {}
    for (_, _, label), error in zip(made, errors):
        sums[label] = sums.get(label, 0) + error
    expected = sorted(((i, c, e, sums[label], digest) for (i, _, label), c, e in zip(made, codes, errors)), key=repr)
    assert sorted(map(tuple, orchard.compress(table).collect()), key=repr) == expected


def test_search_looks_at_less_than_everything_and_ties_go_low():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, size=(16, 6))
    entries = (centres[rng.integers(0, 16, 256)] + rng.integers(-40, 40, size=(256, 6))).astype(np.int64)
    entries[200:] = entries[:56]  # repeated entries: the lower one is the nearest
    rows = (centres[rng.integers(0, 16, 3000)] + rng.integers(-60, 60, size=(3000, 6))).astype(np.int64)
    own, gap, computed = orchard.Codebook(entries).nearest(rows)
    gaps = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (own == gaps.argmin(axis=1)).all() and (gap == gaps.min(axis=1)).all()
    assert computed < 0.4 * gaps.size


def test_huge_and_no_vectors(spark):
    huge = spark.createDataFrame([(1, [3e38] * 4, 0), (2, [-3e38] * 4, 0)], "vec_id long, embedding array<float>, label int")
    assert [(r.vec_id, r.error) for r in orchard.compress(huge).orderBy("vec_id").collect()] == [(1, 0), (2, 0)]
    assert orchard.compress(huge.limit(0)).collect() == []
    assert orchard.compress(huge.withColumn("vec_id", F.lit(None).cast("long"))).collect() == []
