"""Every operator against a brute-force version, with hard cases and empty tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

from tidemark.llm import (
    cover_tree,
    edit_counts,
    impact_search,
    line_dedup,
    mixing,
    odd_sketch,
    pii,
    segment_sampling,
    sharding,
    toxicity,
)
from tidemark.llm.queries import BYTE_PAIRS, PIECES, tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, shard int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


_rng = random.Random(5)
WORDS = ["".join(_rng.choice("aeioustrnl") for _ in range(_rng.randint(2, 7))) for _ in range(400)]


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, ties, NULL, empty, blank and very long texts, a hot text."""
    rng = random.Random(1)
    base = [prose(rng, rng.randint(3, 120)) for _ in range(40)]
    near = []
    for text in base[:12]:
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    lines = ["\n".join(rng.sample(base, 3)) for _ in range(10)]
    hot = ["the very same words stand here again and again without any change"] * 30
    odd = [None, "", " \t\n", "one", "a\n\nb", prose(rng, 5000), "été ÜBER naïve ▁ 日本 😀 x"]
    return base + near + lines + hot + odd


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [
        (i, t, "en", [None, "a", "b", "c"][min(i % 7, 3)], len(t or ""), 1, 2)
        for i, t in enumerate(texts)
    ]
    rows += [rows[0], rows[0], (None, texts[1], None, None, None, 1, 2), (3, "other text", "x", "a", 1, 1, 2)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


# mixing


def test_mix_meets_targets_and_repeats(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert sum(sizes.values()) == sum(len(WORD.findall(t or "")) for _, t in plain(docs))
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while True:  # the excess goes round until none is above
        rest = [s for s in order if s not in full]
        share = left / sum(weight[s] for s in rest)
        over = [s for s in rest if share * weight[s] > 3 * sizes[s]]
        if not over:
            target |= {s: share * weight[s] for s in rest}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            full.add(s)
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in order)
    again = sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    assert sorted(map(tuple, rows), key=repr) == again


def test_mixed_documents_keep_columns(docs, none):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in out.collect()} <= set(plain(docs))
    assert mixing.mix(none).count() == 0
    assert mixing.mixed_documents(none).count() == 0


# line dedup


def words_of(line):
    return tuple(re.findall(r"[^ \t\n\x0b\x0c\r]+", line))


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def test_lines_against_all_pairs(spark, none):
    rng = random.Random(3)
    pool = [prose(rng, rng.choice([4, 9, 10, 11, 30])) for _ in range(25)]
    for line in list(pool):
        words = line.split()
        at = rng.randrange(len(words))
        pool += [
            " ".join([*words[:at], "zz", *words[at:]]),
            " ".join(words[:at] + words[at + 1 :]),
            " ".join([*words[:at], "qq", *words[at + 1 :]]),
        ]
    rows = [(i, "\n".join(rng.choices(pool, k=6)) + "\n") for i in range(40)]
    rows += [(40, None), (41, ""), (42, rows[0][1]), (42, rows[0][1]), (43, " \t " + pool[0])]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    seen, expected = [], Counter()
    for i, text in rows[:43] + rows[44:]:  # a repeated row is one document
        if text is None:
            expected[i, None] += 1
            continue
        kept = []
        for line in text.split("\n"):
            words = words_of(line)
            again = len(words) >= 5 and any(
                words == w or (min(len(words), len(w)) >= 10 and one_edit(words, w)) for w in seen
            )
            seen.append(words)
            if not again:
                kept.append(line)
        expected[i, "\n".join(kept)] += 1 + (i == 42)
    assert Counter((r["doc_id"], r["text"]) for r in got) == expected
    assert line_dedup.dedup_lines(none).count() == 0
    assert line_dedup.without_repeated_lines(none).columns == none.columns


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + rng.choice([0, 1, 1])] = rng.choice([[], ["zz"], [f"q{rng.random()}"]])
    return words


def test_long_lines_a_tenth_apart_against_all_pairs(spark):
    rng = random.Random(8)
    passage = prose(rng, 30).split()  # a passage that many unlike lines hold
    pool = [prose(rng, rng.choice([39, 40, 44, 60, 75, 130])).split() for _ in range(14)]
    pool += [passage + prose(rng, 25).split() for _ in range(20)]
    pool += [["so"] * 60, ["so", "on"] * 30]
    pool += [edited(rng, w, e) for w in list(pool) for e in (1, 2, 3, 4, 7, 14)]
    rng.shuffle(pool)
    rows = [(i, " ".join(w)) for i, w in enumerate(pool)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = {
        i: any(
            edits(w, e) <= (min(len(w), len(e)) // 10 if min(len(w), len(e)) >= 40 else 1)
            for e in pool[:i]
        )
        for i, w in enumerate(pool)
    }
    assert {r["doc_id"]: r["n_dropped"] == 1 for r in got} == expected
    assert 60 < sum(expected.values()) < len(pool) - 60


def test_planted_edits_of_long_lines_are_found(spark):
    rng = random.Random(9)
    base = [prose(rng, 60 + i).split() for i in range(8)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i, w in enumerate(base):
        for e in (2, 3, 4):
            words = list(w)
            for at in rng.sample(range(len(w)), e):
                words[at] = "changed"
            rows.append((100 * e + i, " ".join(words)))
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["n_dropped"]} == {i for i, _ in rows if i >= 100}


# sharding


def test_shards_are_near_equal_and_gapless(docs, texts, none):
    rows = sharding.shard_documents(docs, shards=4).collect()
    assert len(rows) == docs.count()
    held: dict[int, list[Row]] = {}
    for r in rows:
        held.setdefault(r["shard"], []).append(r)
    for part in held.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    small = [r for r in rows if r["size"] < 5000]
    sizes = Counter()
    for r in small:
        sizes[r["shard"]] += r["size"]
    total = sum(r["size"] for r in rows)
    largest = max(r["size"] for r in rows)
    for part in held.values():
        assert abs(sum(r["size"] for r in part) - total / 4) <= largest
    by_id = {i: t or "" for i, t in enumerate(texts)}
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] != 3:
            data = by_id[r["doc_id"]].encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    assert sharding.shard_documents(none).count() == 0


def test_a_hot_text_is_split_where_it_must(spark):
    rows = [(i, "same") for i in range(300)] + [(300 + i, f"t{i}" * 3) for i in range(100)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8)
    sizes = Counter()
    for r in out.collect():
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8
    assert max(abs(s - mean) for s in sizes.values()) <= 40


# embeddings


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    group = base[0] + rng.normal(scale=0.25, size=(40, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.vstack([base, group]))]
    rows += [(100 + i, rows[1][1]) for i in range(20)]  # a hot vector
    rows += [(120, [2 * x for x in rows[1][1]]), (121, [1.0, 0.0]), (122, [1.0, 0.0])]
    rows += [(123, None), (124, [0.0] * 8), (125, [float("nan")] * 8), (126, [None] + [1.0] * 7)]
    rows += [(127, [float("inf")] + [1.0] * 7), (128, []), (None, rows[2][1]), (3, rows[3][1])]
    rows += [(150, rows[4][1]), (200, rows[5][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("block_rows", [8, 8192])
def test_links_against_all_pairs(vectors, block_rows):
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    n = len(rows)
    unit = [np.array(v) / np.linalg.norm(v) if usable(v) else None for _, v in rows]
    link = [
        [
            i != j and unit[i] is not None and unit[j] is not None
            and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= 0.9
            for j in range(n)
        ]
        for i in range(n)
    ]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i]] + [label[j] for j in range(n) if link[i][j]]) for i in range(n)]
    expected = Counter()
    for i, (id_, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        expected[id_, sum(link[i]), least, id_ == least] += 1
    got = cover_tree.near_duplicates(vectors, 0.9, block_rows).collect()
    assert Counter(map(tuple, got)) == expected


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.near_duplicates(empty).count() == 0
    numbers = impact_search.whole_numbers(empty)
    assert impact_search.top_k(numbers, numbers).count() == 0


@pytest.mark.parametrize("index_rows", [16, 8192])
def test_top_k_against_all_products(vectors, index_rows):
    held = []
    for r in vectors.collect():
        v = r["embedding"]
        if r["vec_id"] is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) for x in v]
        held.append((r["vec_id"], whole))
    assert len({i for i, _ in held}) < len(held)  # ids that repeat, with equal vectors or others
    numbers = impact_search.whole_numbers(vectors)
    expected = Counter()
    for q in {i for i, _ in held if i % 50 == 0}:
        scored = sorted(
            (-sum(a * b for a, b in zip(own, v, strict=False)), i)
            for j, own in held if j == q
            for i, v in held if i != q
        )
        expected.update((q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5]))
    found = impact_search.top_k(numbers, numbers.where("vec_id % 50 = 0"), 5, index_rows)
    assert Counter(map(tuple, found.collect())) == expected


def test_rows_of_one_id_all_take_part(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.9, 0.1]), (1, [-0.9, 0.1]), (2, [0.5, 0.5]), (2, [0.5, 0.5])]
    numbers = impact_search.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = impact_search.top_k(numbers, numbers.where("vec_id = 0"), 4).collect()
    assert [tuple(r) for r in sorted(found)] == [
        (0, 1, 1, 256 * 230), (0, 2, 2, 256 * 128), (0, 3, 2, 256 * 128), (0, 4, 2, 256 * 128)
    ]


def test_a_query_with_few_others_gets_all(spark):
    two = spark.createDataFrame([(0, [1, -2]), (1, [3, 4])], "vec_id long, vector array<long>")
    assert [tuple(r) for r in impact_search.top_k(two, two.where("vec_id = 0")).collect()] == [
        (0, 1, 1, -5)
    ]


# near duplicates


@pytest.mark.parametrize("few", [1, 48])
def test_near_duplicates_against_all_pairs(docs, none, monkeypatch, few):
    monkeypatch.setattr(odd_sketch, "FEW", few)
    rows = plain(docs)
    sets = []
    for _, text in rows:
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
        k = min(4, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    n = len(rows)
    label = list(range(n))
    pairs = [
        (i, j) for i, j in itertools.combinations(range(n), 2)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    for _ in range(n):
        before = list(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    expected = Counter()
    for i, (id_, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        expected[id_, len(sets[i]), least, id_ == least] += 1
    got = odd_sketch.near_duplicates(docs, words=4, percent=80)
    got = got.select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert Counter(map(tuple, got)) == expected
    assert odd_sketch.near_duplicates(none).count() == 0


def test_a_crowd_of_near_copies(spark):
    rng = random.Random(8)
    words = [rng.choice(WORDS) + str(i) for i in range(100)]
    rows = []
    for i in range(150):
        mine = list(words)
        for at in rng.sample(range(100), rng.randint(1, 6)):
            mine[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(mine)))
    sets = [
        {tuple(t.split()[i : i + 4]) for i in range(97)} for _, t in rows
    ]
    label = list(range(150))
    links = [
        (i, j) for i, j in itertools.combinations(range(150), 2)
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    for _ in range(150):
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    got = odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == dict(enumerate(label))


def test_pipeline_stage_keeps_one_of_a_group(docs):
    kept = odd_sketch.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    copies = [r for r in kept.collect() if (r["text"] or "").startswith("the very same words")]
    assert len(copies) == 1


# toxicity


def test_toxicity_on_held_out_rows(spark, none):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        toxic = rng.random() < 0.2
        words = prose(rng, 40).split()
        if toxic:
            words[rng.randrange(40)] = rng.choice(["vilen", "vilest", "nastyor", "Nasty!"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (902, "vilen " + prose(rng, 20_000)), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, labels[0], (None, 1), (5000, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.flag(docs, marks).collect()}
    assert len(got) == len(rows)
    wrong = 0
    for i, toxic in labels:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i]["score"] <= 1
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.3)
        wrong += got[i]["held_out"] and got[i]["predicted"] != toxic
    assert wrong <= 5
    assert got[902]["predicted"] == 1 and got[900]["predicted"] == 0
    assert got[900]["score"] == got[901]["score"]
    assert toxicity.flag(none, marks).count() == 0
    unlabelled = toxicity.flag(docs, marks.where("false"))
    assert {r["score"] for r in unlabelled.collect()} == {0.5}


def test_pairs_of_terms_count_for_more_than_their_parts():
    rng = random.Random(6)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        text = prose(rng, 6) + " groupmention" * a + " slurword" * b
        rows.append(toxicity.terms(text).astype(np.int64))
        labels.append(int(a and b))
    machine = toxicity.fit(rows, labels)
    assert len(machine.factors) and np.abs(machine.factors).max() > 0
    tables = machine.tables()
    both, one = (
        machine.margin(toxicity.terms(t), tables) for t in ("groupmention slurword", "slurword")
    )
    assert both > 0 > one


# personal data


def brute_spans(text):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        odd, even = digits[::-1][::2], digits[::-1][1::2]
        if 16 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)) % 10 == 0:
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def test_base_spans_on_random_text():
    rng = random.Random(9)
    parts = ["a@b.c", "x.y@", "@z.de", "@", ".", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111111111111112",
             "+1 (234) 555-0199", "+", "12", " ", "é", "\n", "-", "0001.1.1.01", "b%c@d-e.f.g"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 8)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_paths_and_posteriors_against_enumeration():
    cutter = pii.Segmenter()
    region = "+1 234 5678"
    units = cutter.units(region)
    segments = cutter.segments(region, units)
    rng = np.random.default_rng(1)
    scores, between = rng.normal(size=(len(segments), 4)), rng.normal(size=(5, 5))

    def ways(at, last):
        if at == len(units):
            yield 0.0, ()
            return
        for worth, path in ways(at + 1, 0):
            yield worth + between[last, 0], path
        for s, (i, j, _) in enumerate(segments):
            if i == at:
                for kind in range(1, 5):
                    for worth, path in ways(j, kind):
                        yield worth + between[last, kind] + scores[s, kind - 1], ((s, kind), *path)

    every = list(ways(0, 0))
    total, held, _ = pii._posterior(len(units), segments, scores, between)
    assert total == pytest.approx(np.logaddexp.reduce([w for w, _ in every]))
    for s, kind in [(0, 1), (len(segments) - 1, 4)]:
        share = sum(math.exp(w - total) for w, path in every if (s, kind) in path)
        assert held[s, kind - 1] == pytest.approx(share)
    assert tuple(pii.best_path(len(units), segments, scores, between)) == max(every)[1]


def test_pii_over_documents(spark, docs, none):
    rng = random.Random(2)
    rows = [(i, f"{prose(rng, 8)} {rng.choice(['me@x.org', '10.1.2.3', '+1 (234) 555-0199'])} {prose(rng, 5)}") for i in range(60)]
    rows += [(60, None), (61, ""), (62, prose(rng, 20_000) + " me@x.org")]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in found.collect():
        base = pii.joined(brute_spans(r["text"] or ""))
        assert r["base_spans"] == base
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
    assert pii.find_pii(none).count() == 0
    assert all(r["spans"] == "" for r in pii.find_pii(docs.where("text is null")).collect())


# token counts


@pytest.fixture(scope="module")
def count():
    return edit_counts.byte_pair_counter(*tokenizer(BYTE_PAIRS))


def test_random_edits_against_counting_anew(count):
    rng = random.Random(7)
    for _ in range(150):
        text = "".join(rng.choices([*WORDS[:40], " ", " ", " ", "  ", "\n", ".", "'s", "é", "12"], k=rng.randint(0, 700)))
        ends = edit_counts.leaf_ends(text)
        counts = [count(text[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
        assert sum(counts) == count(text)
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 2 * rng.randint(0, 5))))
        edits = [(a, b, rng.choice(["", " ", "x", "  word", ". New "])) for a, b in zip(cuts[::2], cuts[1::2], strict=False)]
        tree = edit_counts.CountedText(text, ends, counts, count)
        tree.apply(edits)
        fresh = text
        for a, b, put in reversed(edits):
            fresh = fresh[:a] + put + fresh[b:]
        assert tree.text == fresh
        assert tree.tree.total == count(fresh)
        assert sum(tree.tree.sums[tree.tree.width :]) == tree.tree.total


def test_recount_over_documents(docs, none, count):
    files = tokenizer(BYTE_PAIRS)
    out = edit_counts.recount(edit_counts.number_edits(edit_counts.count_tokens(docs, *files)), *files)
    for r in out.collect():
        assert r["n_tokens"] == count(r["text"] or "")
        assert r["n_tokens_after"] == count(re.sub(r"[0-9]{7,}", "0", r["text"] or ""))
    assert edit_counts.count_tokens(none, *files).count() == 0


# segmentations


@pytest.fixture(scope="module")
def model():
    return tokenizer(PIECES)[0]


def test_samples_are_distinct_and_decode(docs, none, model):
    rows = segment_sampling.sample_segmentations(docs, model, k=3).collect()
    by_row = Counter((r["doc_id"], tuple(r["ids"])) for r in rows if r["doc_id"] not in (0, 3, None))
    assert max(by_row.values()) == 1
    assert all(r["round_trip"] and 0 < r["inclusion"] <= 1 or r["log_prob"] < -600 for r in rows)
    texts = dict(plain(docs.where("doc_id <> 3")))
    decoded = segment_sampling.decode(
        docs.sparkSession.createDataFrame([(r["doc_id"], r["ids"]) for r in rows], "doc_id long, ids array<int>"), model
    )
    assert all(r["text"] == (texts[r["doc_id"]] or "") for r in decoded.where("doc_id <> 3").collect())
    assert all(
        hashlib.md5(np.array(r["ids"], "<i4").tobytes()).hexdigest() == r["ids_md5"] for r in rows
    )
    assert segment_sampling.sample_segmentations(none, model).count() == 0


def test_sampling_without_replacement_is_exact(model):
    vocabulary = segment_sampling.read_vocabulary(model, sharpness=0.15)
    prefixes = segment_sampling.Prefixes(vocabulary)
    pieces = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.normal[i]}

    def every(rest):
        if not rest:
            yield 0.0, ()
        for end in range(1, len(rest) + 1):
            if rest[:end] in pieces:
                for weight, tail in every(rest[end:]):
                    yield weight + vocabulary.weights[pieces[rest[:end]]], (pieces[rest[:end]], *tail)

    found = list(every("▁in▁it"))
    total = np.logaddexp.reduce([w for w, _ in found])
    share = {ids: math.exp(w - total) for w, ids in found}
    n = 20_000
    batch = segment_sampling.Batch(["in it"] * n, np.arange(n), vocabulary, prefixes)
    left = batch.search(2)
    first, second = (
        Counter(tuple(batch.ids(p, t, vocabulary)) for t in range(n)) for p in batch.paths
    )
    for ids, p in share.items():
        assert first[ids] / n == pytest.approx(p, abs=0.015)
        later = sum(q * p / (1 - q) for other, q in share.items() if other != ids)
        assert second[ids] / n == pytest.approx(later, abs=0.015)
    weighed = sum(
        np.exp(p.log_prob) / -np.expm1(-np.exp(p.log_prob - left)) for p in batch.paths
    )
    assert weighed.mean() == pytest.approx(1, abs=0.03)


def test_a_text_with_few_segmentations_gives_all(spark, model):
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    rows = segment_sampling.sample_segmentations(one, model, k=9).collect()
    assert len(rows) == 2  # with the space apart or not
    assert sum(math.exp(r["log_prob"]) for r in rows) == pytest.approx(1)
    assert {r["inclusion"] for r in rows} == {1.0}


def test_characters_beyond_16_bits_go_as_their_pieces(spark, model):
    vocabulary = segment_sampling.read_vocabulary(model)
    pieces = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.normal[i]}
    far = [p for p in pieces if len(p) == 1 and ord(p) > 0xFFFF]
    assert len(far) == 59
    bare = next(chr(c) for c in range(0x1F600, 0x20000) if chr(c) not in pieces)

    def every(rest):
        if not rest:
            yield 0.0, ()
        for end in range(1, len(rest) + 1):
            if rest[:end] in pieces:
                for weight, tail in every(rest[end:]):
                    yield weight + vocabulary.weights[pieces[rest[:end]]], (pieces[rest[:end]], *tail)
        if rest and rest[0] not in pieces:
            ids = tuple(int(vocabulary.byte_ids[b]) for b in rest[0].encode())
            for weight, tail in every(rest[1:]):
                yield weight + vocabulary.byte_weight * len(ids), ids + tail

    texts = [*far, f"a{far[0]}{bare}it{far[-1]}", f"{bare}{far[1]} {far[1]}in", f"{bare}\U0010ffff"]
    rows = segment_sampling.sample_segmentations(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, k=40
    ).collect()
    for t, text in enumerate(texts):
        expected = {ids: w for w, ids in every("▁" + text.replace(" ", "▁"))}
        total = np.logaddexp.reduce(list(expected.values()))
        got = {tuple(r["ids"]): r["log_prob"] for r in rows if r["doc_id"] == t}
        assert got == pytest.approx({ids: w - total for ids, w in expected.items()})
        assert all(r["round_trip"] for r in rows if r["doc_id"] == t)
