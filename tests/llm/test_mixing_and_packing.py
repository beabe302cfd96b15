import itertools
import os
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import common, exact_dedup, jaccard_join, mixing, packing
from ledgerloom.sources.workspace import work_scope

SCHEMA = "doc_id long, text string, source string, digest string, shard string, position string, _id string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "x", "x", "x", len(t or "")) for i, t, s in rows], SCHEMA)


def _corpus():
    random.seed(4)
    rows = []
    for i in range(300):
        source = random.choice(["a", "b", "c", "d", None]) if i % 3 else "a"
        rows.append((i, " ".join(["w"] * random.randint(0, 60)), source))
    rows += [(300, None, "a"), (301, "", "b"), (302, " \n ", None), (303, "w " * 30_000, "e")]
    return rows


def _filled(sizes, weights, most):
    left, share, held = dict(sizes), {}, {}
    total = sum(sizes.values())
    while True:
        level = (total - sum(held.values())) / sum(weights[s] for s in left)
        over = [s for s in left if most * sizes[s] < weights[s] * level]
        if not over:
            return held | {s: weights[s] * level for s in left}
        for s in over:
            held[s] = most * sizes[s]
            del left[s]


def test_targets_and_taken(spark):
    rows = _corpus()
    found = mixing.mix(_docs(spark, rows), rows_per_shard=7).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    ranked = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = _filled(sizes, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(ranked)}, 3)
    taken = {}
    for r in found:
        assert abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert [p.position for p in r.placements] == sorted(p.position for p in r.placements)
        assert all(0 <= p.position <= 1 for p in r.placements)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(taken[s] == int(target[s] + 1e-9) for s in sizes)
    again = mixing.mix(_docs(spark, rows), rows_per_shard=7).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_training_order_and_mixed_documents(spark):
    rows = _corpus()
    docs = _docs(spark, rows)
    order = [r.position for r in mixing.training_order(mixing.mix(docs)).collect()]
    assert order == sorted(order)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = mixed.agg(F.sum(common.word_count(F.col("text")))).first()[0]
    assert words == mixing.mix(docs).agg(F.sum("taken")).first()[0]
    assert mixed.filter("n_chars <> length(text)").isEmpty()


def test_repeated_rows_are_mixed_each(spark):
    docs = _docs(spark, [(i // 4, "w " * (1 + i // 4 % 7), "ab"[i % 8 // 4]) for i in range(120)] + [(3, "v v", "a")])
    text = F.col("text")
    uses = mixing.mixed_documents(docs).groupBy("doc_id", text.startswith("w").alias("first")).agg(F.count("*"), F.sum(common.word_count(text)))
    found = {tuple(r)[:2]: tuple(r)[2:] for r in uses.collect()}
    expected = {}
    for r in mixing.mix(docs).collect():
        key = (r.doc_id, not (r.doc_id == 3 and r.size == 2))
        uses, words = expected.get(key, (0, 0))
        expected[key] = (uses + len(r.placements), words + r.taken)
    assert found == {k: v for k, v in expected.items() if v[0]}


def test_rows_without_an_id_stay_to_the_end(spark):
    """Through dedup, similar texts and mixing: one of three copies, and a text of its own."""
    words = " ".join(f"w{i}" for i in range(40))
    docs = _docs(spark, [(None, words, "a")] * 2 + [(None, words + "  ", "a"), (None, "one of its own", "a"), (1, "with an id", "a"), (None, "with  an id", "a")])
    left = jaccard_join.one_row_of_each(exact_dedup.one_row_of_each(docs))
    assert sorted((r.doc_id or 0, r.text.split()[0]) for r in left.collect()) == [(0, "one"), (0, "w0"), (1, "with")]
    assert mixing.mixed_documents(left).count() == mixing.training_order(mixing.mix(left)).count() == 3


def test_schedule_is_inverted(spark):
    corners = ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))
    shares = [i / 20 for i in range(21)]
    times = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.time_of_share(F.col("s"), corners)).collect()]

    def demand(t, steps=4000):
        weight = [0.5 + (i + 0.5) / steps for i in range(steps)]
        return sum(weight[: round(t * steps)]) / sum(weight)

    assert all(abs(demand(t) - s) < 1e-3 for s, t in zip(shares, times))


def test_mixing_nothing(spark):
    assert mixing.mix(_docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(_docs(spark, [(1, None, None)])).collect()] == [0]


def test_offsets_over_many_blocks(spark):
    rows = [(i, i % 2, 1 + i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "i long, g int, v int").withColumn("digest", common.digest_of(F.col("i")))
    df = df.withColumn("shard", common.shard_of(F.col("digest"), 90)).withColumn("tie", F.col("i"))
    found = common.with_offsets(df, ["g"], "v", 90, fanout=4).collect()
    for g in (0, 1):
        total = 0
        for r in sorted((r for r in found if r.g == g), key=lambda r: r.digest):
            assert r.offset == total
            total += r.v


def _padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 20), min_size=1, max_size=9), st.integers(1, 4))
def test_boundaries_are_optimal(histogram, buckets):
    lengths = sorted(histogram)
    counts = [histogram[n] for n in lengths]
    ends = packing.optimal_boundaries(lengths, counts, buckets)
    assert ends[-1] == lengths[-1] and len(ends) <= buckets
    best = min(
        _padding(lengths, counts, [*chosen, lengths[-1]])
        for k in range(buckets)
        for chosen in itertools.combinations(lengths, min(k, len(lengths)))
    )
    assert _padding(lengths, counts, ends) == best


def test_batches(spark):
    rows = _corpus() + [(5, "w w w", "a"), (None, "w", "a")]
    packed = packing.pack(_docs(spark, rows), buckets=4, token_budget=100, rows_per_shard=9).collect()
    assert len(packed) == len(rows)
    batches = {}
    for r in packed:
        if not r.length:
            assert r.bucket is None and r.batch is None
            continue
        assert r.padding == r.padded_length - r.length >= 0
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, number), inside in batches.items():
        fits = max(1, 100 // inside[0].padded_length)
        last = max(n for b, n in batches if b == bucket)
        assert sorted(r.batch_row for r in inside) == list(range(len(inside)))
        assert len(inside) == fits or number == last and len(inside) < fits
    assert packing.pack(_docs(spark, [])).count() == 0


def test_cells_are_bounded(spark):
    lengths = [1, 4096, 4097, 5000, 70_001, 2**40 + 1]
    tops = [r[0] for r in spark.createDataFrame([(n,) for n in lengths], "n long").select(packing.cell_top(F.col("n"))).collect()]
    assert tops[:2] == [1, 4096]
    assert all(n <= t <= n * (1 + 1 / 2048) + 1 for n, t in zip(lengths, tops))


def test_batches_follow_the_order_of_the_table(spark, tmp_path):
    docs = _docs(spark, _corpus() * 2)
    written = docs.withColumn("at", F.xxhash64("doc_id", "text", "source")).repartitionByRange(5, "at").sortWithinPartitions("at")
    written.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    packed = packing.pack_in_order(table, buckets=3, token_budget=150, rows_per_shard=7).collect()
    assert sorted(r.position for r in packed) == list(range(table.count()))
    # the table's own order: by file, then by place in it
    places = table.select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    order = [r.doc_id for r in sorted(places, key=lambda r: (r.file_name, r.row_index))]
    assert [r.doc_id for r in sorted(packed, key=lambda r: r.position)] == order
    for bucket in {r.bucket for r in packed} - {None}:
        inside = sorted((r for r in packed if r.bucket == bucket), key=lambda r: r.position)
        places = [(r.batch, r.batch_row) for r in inside]
        assert places == sorted(places) and len(set(places)) == len(places)
        assert {r.padded_length for r in inside} == {max(r.length for r in inside)}


def test_written_tables_are_numbered_where_they_lie(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("row"), F.col("id").alias("_file"), F.lit(1).alias("doc"))
    rows.repartitionByRange(4, "row").sortWithinPartitions("row").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    with work_scope(spark) as path:
        assert all(r.row == r.doc.row for r in common.numbered(table).collect())
        assert not os.path.exists(path)
        # rows that were left out or are not in a file are numbered after being written
        for other in (table.filter("row % 3 = 0"), table.unionByName(table), table.withColumn("_metadata", F.lit(1))):
            numbers = [r.row for r in common.numbered(other).collect()]
            assert sorted(numbers) == list(range(other.count()))


def test_rows_without_an_id_are_spread(spark):
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"), F.lit("a").alias("source"))
    spread = docs.select(common.shard_of(common.digest_of(F.col("doc_id"), F.col("text")), 40).alias("shard")).groupBy("shard").count()
    assert spread.count() == 40 and spread.agg(F.max("count")).first()[0] < 700
    assert packing.pack(docs).count() == mixing.mix(docs).count() == 20_000
