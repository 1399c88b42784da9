"""Repeated passages, similar lines, exact and near copies, against plain versions."""

from __future__ import annotations

import hashlib
import os
import random

import numpy as np
import plain
import pytest
from finmart.llm import lines, recipes, repeats, simhash
from finmart.llm.oracle import ORACLE_SQL
from finmart.llm.queries import QUERIES
from finmart.llm.suffixes import sort_strings
from finmart.sources.scratch import scratch_root
from plans import final_plan_of, settings
from pyspark.sql import functions as F
from samples import ROWS

from compare import duck, duck_bag, spark_bag


def documents(spark, sf_dir) -> list[tuple[int, str]]:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return sorted(map(tuple, rows))


def expected_bytes(rows, length: int):
    raw = [(text or "").encode() for _, text in rows]
    for (key, _), text, spans in zip(rows, raw, plain.repeated(raw, length)):
        kept = b"".join(text[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(text)]))
        yield key, len(text), spans, kept


def test_strings_are_sorted_and_told_apart():
    draw = random.Random(5)
    for _ in range(200):
        starts = [b"x" * draw.choice([0, 5, 31, 32, 33, 40, 50]) for _ in range(3)]
        strings = [
            draw.choice(starts) + bytes(draw.choices(b"ab\0", k=draw.randint(0, 12)))
            for _ in range(draw.randint(1, 50))
        ]
        group = np.array([draw.randint(0, 2) for _ in strings])
        sizes = np.array([len(s) for s in strings])
        data = np.frombuffer(b"".join(strings) + b"\0", np.uint8)
        order, part = sort_strings(data, np.cumsum(sizes) - sizes, sizes, group)
        got = [(int(group[i]), strings[i]) for i in order]
        assert got == sorted(got)
        assert [a == b for a, b in zip(got, got[1:])] == (part[1:] == part[:-1]).tolist()


def test_repeat_query(spark, sf_dir):
    rows = documents(spark, sf_dir)
    expected = {
        (key, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for key, n, spans, kept in expected_bytes(rows, 200)
    }
    assert {tuple(row) for row in QUERIES["op1_repeats"](spark, sf_dir).collect()} == expected


@pytest.mark.parametrize("length", [32, 48, 200])
def test_repeats_of_odd_rows(spark, docs, none, length):
    got = repeats.drop_repeats(docs, length).collect()
    found = sorted((str(r.doc_id), r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got)
    assert found == sorted((str(k), n, spans, kept) for k, n, spans, kept in expected_bytes(ROWS, length))
    assert repeats.drop_repeats(none, length).count() == 0


def test_repeats_over_segments_and_blocks(spark, monkeypatch):
    # Workers read these numbers from the module, so the parts are called in this process.
    draw = random.Random(2)
    words = [bytes(draw.choices(b"abcd", k=50)) for _ in range(12)]
    texts = [b"".join(draw.choices(words, k=draw.randint(0, 12))) for _ in range(60)]
    whole = repeats.Runs(texts, 64)
    monkeypatch.setattr(repeats, "_SEGMENT", 100)
    parts = repeats.Runs(texts, 64)
    assert (whole.anchor == parts.anchor).all()
    assert (whole.first == parts.first).all()


def test_hot_passages_with_different_surroundings_are_spread(spark, monkeypatch):
    draw = random.Random(8)

    def noise(n):
        return "".join(draw.choices("abcdefgh", k=n))

    passage, other = noise(500), noise(120)
    texts = [noise(100) + passage + noise(100) for _ in range(80)]
    texts += [passage[:300] + noise(50), noise(50) + passage[150:], other * 9, noise(9) + other * 9, "é" * 300]
    texts += [texts[0], f"{texts[1]} {texts[2]}"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4, "doc_id")
    groups = []
    sort = repeats._sort_runs

    def watched(runs, length):
        with_text = runs.where("text is not null").groupBy("hash").count()
        groups.append(with_text.agg(F.max("count")).head()[0])
        return sort(runs, length)

    monkeypatch.setattr(repeats, "_sort_runs", watched)
    for hot in (3, 20_000):
        monkeypatch.setattr(repeats, "_HOT", hot, raising=False)
        got = repeats.drop_repeats(docs, 200).collect()
        found = sorted((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got)
        assert found == sorted(expected_bytes(rows, 200))
    assert groups[0] <= 2 * 4 < 80 <= groups[1]  # at most twice a task


def test_hot_strings_are_sent_twice_at_most():
    sent, first = {}, b"x" * 10 + bytes(range(40))
    run = [1, 2, 0, 10, 19, 1]
    out = [repeats._cut_strings(run, first, 5, 32, {}, sent) for _ in range(3)]
    assert [entry[:1] + entry[3:] for entry in out[0]] == [entry[:1] + entry[3:] for entry in out[1]]
    assert [entry[7] for entry in out[0]] == [first[k : k + 32] for k in range(19)]
    assert [(entry[3], entry[5], entry[6], entry[7]) for entry in out[2]] == [(0, 19, 2, None)]


def test_line_query(spark, sf_dir):
    rows = documents(spark, sf_dir)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in QUERIES["op3_similar_lines"](spark, sf_dir).collect()}
    assert got == {
        key: (text.count("\n") + 1, len(gone), ",".join(map(str, gone)))
        for (key, text), gone in zip(rows, plain.removed_lines(rows))
    }


def test_lines_of_odd_rows(spark, docs, none):
    rows = sorted(ROWS, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    got = lines.mark_lines(docs).collect()
    assert len(got) == len(ROWS)
    assert sorted(r.n_removed for r in got) == sorted(map(len, plain.removed_lines(rows)))
    assert lines.mark_lines(none).count() == 0


def test_groups_of_similar_lines_keep_their_first(spark):
    draw = random.Random(4)
    words = [f"w{k}" for k in range(30)]
    texts = []
    for _ in range(120):
        line = words[:]
        for _ in range(draw.randint(0, 3)):
            line[draw.randrange(30)] = f"x{draw.randrange(8)}"
        texts.append("\n".join([" ".join(line), f"lonely {draw.random()}", ""]))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("removed", F.lit("mine"))
    got = {r.doc_id: r.removed for r in lines.mark_lines(docs).collect()}
    expected = dict(zip(range(120), plain.removed_lines(rows)))
    assert got == expected
    left = {r.doc_id: (r.text, r.removed) for r in lines.drop_lines(docs).collect()}
    assert left == {
        k: ("\n".join(line for i, line in enumerate(text.split("\n")) if i not in expected[k]), "mine")
        for k, text in rows
    }


def test_dropping_lines_of_null_and_repeated_ids(spark):
    same = "a b c d e f g h i j"
    rows = [(None, f"one\n{same}"), (None, f"{same}\ntwo"), (5, f"three\n{same}"), (5, f"{same}\nfour\n\nfive")]
    rows += [(5, f"{same}\nfour\n\nfive"), (6, None), (6, None), (6, ""), (7, "six")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    left = [(r.doc_id, r.text) for r in lines.drop_lines(docs).collect()]
    # The earliest line is that of the smallest id, line number and row: here the second text's.
    kept = [(None, "one"), (None, f"{same}\ntwo"), (5, "three"), (5, "four\n\nfive"), (5, ""), (6, None), (6, None), (6, ""), (7, "six")]
    assert sorted(map(str, left)) == sorted(map(str, kept))


def test_similar_lines_share_marks_and_others_hardly_any(spark):
    draw = random.Random(6)
    rows, kin = [], []
    for size in (4, 5, 6, 7, 8, 12, 13, 15, 16, 26, 31, 32, 51, 52, 63, 64, 103, 128, 205, 300):
        for _ in range(12):
            one = [f"w{draw.randrange(10**6)}" for _ in range(size)]
            other = one[:]
            for _ in range(draw.randint(0, size // 4)):
                if draw.random() < 0.5:
                    other[draw.randrange(len(other))] = f"v{draw.randrange(10**6)}"
                else:
                    other.pop(draw.randrange(len(other)))
            a, b = set(one), set(other)
            if 5 * len(a & b) >= 4 * len(a | b):
                kin.append((len(rows), len(rows) + 1))
                rows += [(len(rows), " ".join(one)), (len(rows) + 1, "\t".join(other))]
    # The same rare words in all of these lines, which are not similar.
    rare = len(rows)
    rows += [(rare + k, "zebra quokka " + " ".join(f"u{draw.randrange(10**6)}" for _ in range(30))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = lines._profiles(lines._lines(docs, "doc_id", "text", F.lit(0))).collect()
    marks = {row.id: (row.size, set(row.marks)) for row in found}
    assert len(kin) > 150
    for x, y in kin:
        (a, one), (b, other) = marks[x], marks[y]
        assert len(one & other) >= max(1, min(a, b) // 4 + 1 - (a + b) // 9)
    unlike = [marks[k][1] for k in range(rare, len(rows))]
    assert not any(a & b for i, a in enumerate(unlike) for b in unlike[:i])


def test_a_line_is_compared_with_one_other_first(spark, monkeypatch):
    draw = random.Random(9)
    texts = []
    for _ in range(150):
        line = [f"w{k}" for k in range(40)]
        for _ in range(draw.randint(0, 4)):
            line[draw.randrange(40)] = f"x{draw.randrange(9)}"
        texts.append(" ".join(line))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    most, verified = [], lines._verified

    def watched(pairs, *rest):
        most.append(pairs.groupBy("later").count().agg(F.max("count")).head()[0])
        return verified(pairs, *rest)

    monkeypatch.setattr(lines, "_verified", watched)
    got = {r.doc_id: r.removed for r in lines.mark_lines(docs).collect()}
    assert got == dict(zip(range(150), plain.removed_lines(rows)))
    assert most[0] == 1


def kin(draw, sizes, times):
    """Pairs of similar lines: words that one has and the other lacks, as many as may be."""
    for size in sizes:
        for _ in range(times):
            one = [f"w{draw.randrange(10**6)}" for _ in range(size)]
            other = one[:]
            for _ in range(draw.randint(0, size // 4)):
                if draw.random() < 0.5:
                    other[draw.randrange(len(other))] = f"v{draw.randrange(10**6)}"
                else:
                    other.pop(draw.randrange(len(other)))
            a, b = set(one), set(other)
            if 9 * len(a & b) >= 4 * (len(a) + len(b)):
                yield " ".join(one), " ".join(other)


def test_similar_lines_are_near_and_others_hardly_any(spark):
    draw = random.Random(7)
    pairs = list(kin(draw, (1, 4, 5, 9, 16, 31, 33, 64, 90, 150, 260, 600), 15))
    unlike = [" ".join(f"u{draw.randrange(10**6)}" for _ in range(size)) for size in (32, 64, 128, 200) for _ in range(20)]
    rows = [(2 * k + i, line) for k, pair in enumerate(pairs) for i, line in enumerate(pair)]
    rows += [(-1 - k, line) for k, line in enumerate(unlike)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = lines._profiles(lines._lines(docs, "doc_id", "text", F.lit(0))).select("id", "size", *lines._BITS)
    x, y = found.alias("x"), found.alias("y")
    near = lines._near("x", "y")
    assert x.join(y, (F.col("x.id") % 2 == 0) & (F.col("y.id") == F.col("x.id") + 1) & (F.col("x.id") >= 0) & near).count() == len(pairs)
    assert x.join(y, (F.col("x.id") < F.col("y.id")) & (F.col("y.id") < 0) & near).count() == 0


def test_lines_near_one_another_are_not_written_as_pairs(spark, monkeypatch):
    draw = random.Random(3)
    texts = []
    for k in range(120):
        line = [f"w{i}" for i in range(40)]
        for i in draw.sample(range(40), 3):
            line[i] = f"x{k}y{i}"
        texts.append(" ".join(line))
    texts += texts[50].rsplit(" ", 1)[:1] + [f"{texts[60]} more"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    most, write = {}, lines.materialize

    def watched(df, label, **rest):
        table = write(df, label, **rest)
        most[label] = max(most.get(label, 0), table.count())
        return table

    monkeypatch.setattr(lines, "materialize", watched)
    got = {r.doc_id: r.removed for r in lines.mark_lines(docs).collect()}
    assert got == dict(zip(range(len(rows)), plain.removed_lines(rows)))
    marks = 11 * 2  # of a line with 40 words, should it be cut twice
    assert most["line-pairs"] <= len(rows)
    assert max(most.values()) <= marks * len(rows)


def test_tables_of_marks_are_erased(spark):
    rows = [(k, f"a b c d e f g h {k}\nalone {k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    before = set(os.listdir(f"{scratch_root(spark)}/finmart")) if os.path.isdir(f"{scratch_root(spark)}/finmart") else set()
    assert lines.mark_lines(docs).count() == 20
    left = {name.rpartition("-")[0] for name in set(os.listdir(f"{scratch_root(spark)}/finmart")) - before}
    assert left <= {"line-keys", "line-sets", "followers", "bitmap"}


def test_rarity_classes_of_any_count_fit_seven_bits(spark):
    counts = spark.createDataFrame([(n,) for n in (1, 2, 3, 1000, 2**31, 2**32, 10**12, 2**63 - 1)], "n bigint")
    grades = [r[0] for r in counts.orderBy("n").select(lines._grade(F.col("n"))).collect()]
    assert grades == sorted(grades)
    assert grades[0] == 0 and grades[-1] == 126


@pytest.mark.parametrize("name", ["op7_exact_copies", "op10_chats"])
def test_query_equals_oracle(spark, sf_dir, name):
    with duck(sf_dir) as connection:
        assert spark_bag(QUERIES[name](spark, sf_dir)) == duck_bag(connection, ORACLE_SQL[name])


def weak(chunk):
    """A hash that many chunks share."""
    return F.pmod(F.xxhash64(chunk), F.lit(3))


@pytest.mark.parametrize("hash_of", [F.xxhash64, weak])
def test_copies_of_odd_rows(spark, docs, none, hash_of):
    more = [(100 + k, f"{part} " * 700) for k, part in enumerate("abcdefgabc")]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    groups = plain.copies(ROWS + more)
    got = recipes.find_copies(table, hash_of=hash_of).collect()
    assert len(got) == len(ROWS + more)
    by_digest = {hashlib.sha256(text.encode()).hexdigest(): keys for text, keys in groups.items()}
    kept = []
    for row in got:
        keys = by_digest[row.text_sha256]
        assert row.group_size == len(keys)
        assert row.keep_id == max((k for k in keys if k is not None), default=None)
        if row.kept:
            assert row.doc_id == row.keep_id
            kept.append(row.text_sha256)
    assert sorted(kept) == sorted(by_digest)
    assert recipes.find_copies(none, hash_of=hash_of).count() == 0


def test_chunks_make_up_the_text(spark, docs):
    parts = docs.select("text", recipes.chunks(F.col("text")).alias("parts")).where("text is not null")
    for row in parts.collect():
        assert "".join(row.parts) == row.text
        assert all(len(part) >= recipes.CHUNK_LEAST for part in row.parts[:-1])
        assert all(len(part) <= recipes.CHUNK_MOST for part in row.parts)


def test_an_insertion_changes_few_chunks(spark):
    text = " ".join(f"word{i * i % 8191}" for i in range(20_000))
    rows = [(1, text), (2, text[:5000] + "inserted" + text[5000:])]
    table = spark.createDataFrame(rows, "doc_id int, text string")
    one, two = (set(r.parts) for r in table.select(recipes.chunks(F.col("text")).alias("parts")).collect())
    assert len(one - two) <= 3 < len(one) // 4


def test_dropping_keeps_columns_and_one_of_each(docs, none):
    for drop in (recipes.drop_copies, simhash.one_of_each):
        left = drop(docs)
        assert left.columns == docs.columns
        rows = left.collect()
        assert sum(r.text == ROWS[5][1] for r in rows) == 1
        assert all(r.copy_key.startswith("copy_key-") for r in rows)
        assert drop(none).count() == 0


def test_unrelated_texts_stay_whatever_their_ids(spark):
    draw = random.Random(11)
    texts = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(80)) for _ in range(7)]
    near = f"{texts[4]} more"
    assert plain.components([plain.fingerprint(text) for text in [*texts, near]], 4) == [*range(7), 4]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, near)]
    rows += [(8, texts[4]), (7, texts[5]), (None, texts[5]), (9, texts[6]), (9, texts[6])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = sorted(map(str, simhash.one_of_each(docs).collect()))
    kept = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, near), (7, texts[5]), (9, texts[6])]
    assert left == sorted(map(str, spark.createDataFrame(kept, docs.schema).collect()))


def test_near_copy_query(spark, sf_dir):
    rows = documents(spark, sf_dir)
    values = [plain.fingerprint(text) for _, text in rows]
    places = plain.components(values, 4)
    expected = {
        (key, f"{value:016x}", rows[place][0])
        for (key, _), value, place in zip(rows, values, places)
    }
    assert {tuple(r) for r in QUERIES["op8_near_copies"](spark, sf_dir).collect()} == expected


def test_near_copies_of_odd_rows(spark, docs, none):
    got = simhash.near_duplicates(docs).collect()
    values = [plain.fingerprint(text) for _, text in ROWS]
    places = plain.components(values, 4)
    least = {}
    for (key, _), place in zip(ROWS, places):
        if key is not None:
            least[place] = min(key, least.get(place, key))
    expected = [(key, f"{v:016x}", least.get(p)) for (key, _), v, p in zip(ROWS, values, places)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 5, 7])
def test_bit_sliced_comparison(radius):
    draw = random.Random(radius)
    base = [draw.getrandbits(64) for _ in range(40)]
    values = []
    for value in base:
        for _ in range(5):
            for _ in range(draw.randint(0, 6)):
                value ^= 1 << draw.randrange(64)
            values.append(value)
    bucket = np.sort(np.array([draw.randrange(20) for _ in values]))
    expected = []
    for b in sorted(set(bucket.tolist())):
        at = np.flatnonzero(bucket == b).tolist()
        expected += [at[k] for k in plain.components([values[i] for i in at], radius)]
    assert simhash.linked(bucket, np.array(values, np.uint64), radius).tolist() == expected


def test_large_buckets_are_dealt_again(spark, monkeypatch):
    draw = random.Random(9)
    same = draw.getrandbits(64)
    values = {same}
    for _ in range(150):
        value = same
        for bit in draw.sample(range(64), draw.randint(1, 9)):
            value ^= 1 << bit
        values.add(value)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    marked = spark.createDataFrame([(k, v) for k, v in enumerate(signed)], "id bigint, fp bigint")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: marked)
    monkeypatch.setattr(simhash, "_BUCKET", 6)
    docs = spark.createDataFrame([(0, "")], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == list(enumerate(plain.components(values, 4)))


HOT = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold": "0",
}


def hot_table(spark, n: int = 40_000):
    """A third of the rows share a text, the others are twofold."""
    i = F.col("id")
    text = F.when(i % 3 == 0, "the same few words for all of them").otherwise(
        F.concat(F.lit("words of the pair "), F.md5(F.floor(i / 6).cast("string")))
    )
    return spark.range(0, n, 1, 16).select(i.alias("doc_id"), text.alias("text"))


def test_a_hot_recipe_is_split(spark):
    with settings(spark, **HOT):
        found = recipes.find_copies(hot_table(spark))
        plan = final_plan_of(found)
        assert found.where("kept").count() == hot_table(spark).select("text").distinct().count()
    assert "SortMergeJoin(skew=true)" in plan


def test_a_hot_fingerprint_is_split(spark):
    with settings(spark, **HOT):
        found = simhash.near_duplicates(hot_table(spark, 20_000))
        plan = final_plan_of(found)
    assert "SortMergeJoin(skew=true)" in plan
    with settings(spark, **HOT):
        one = found.groupBy("component_id").count().agg(F.max("count")).first()[0]
    assert one >= 20_000 // 3


def test_a_hot_anchor_is_split(spark):
    i = F.col("id")
    passage = "".join(random.Random(4).choices("ghijklmn", k=120))
    pair = F.concat(F.md5(F.floor(i / 6).cast("string")), F.md5(F.floor(i / 6 + 9).cast("string")))
    text = F.concat(F.md5(i.cast("string")), F.when(i % 3 == 0, passage).otherwise(F.concat(pair, pair)))
    docs = spark.range(0, 20_000, 1, 16).select(i.alias("doc_id"), text.alias("text"))
    with settings(spark, spark__sql__shuffle__partitions="16", **HOT):
        found = repeats.find_repeats(docs, 100)
        plan = final_plan_of(found)
        whole = F.exists("spans", lambda s: (s["start"] <= 32) & (s["stop"] == 32 + 120))
        hot = found.where((i % 3 == 0) & whole).count()
    assert "SortMergeJoin(skew=true)" in plan
    assert hot == 6_667
