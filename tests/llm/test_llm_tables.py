"""Operators over whole tables: lines, near duplicates, search, archives, mixing, the pipeline."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import re
from collections import defaultdict
from pathlib import Path

import compare
import numpy as np
import pytest
from llm_texts import SF, prose

import corpus_pipeline
from txnrisk.llm import lines, mixing, neardup, queries, quality, topk, warc
from txnrisk.sources.scratch import scratch_root

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = compare.connect(SF)
    assert compare.compare(spark, SF, queries.REGISTRY[name], queries.ORACLES[name], con) is None


# Lines


def template_keys(line, lead=3, least=3, general=12):
    tokens = ["<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^ \t\n\x0b\f\r]+", line)]
    n = len(tokens)
    if n < least:
        return []
    keys = [(-1, n, tuple(tokens))]
    for part in range(4 if n >= general else 0):
        a, b = lead + (n - lead) * part // 4, lead + (n - lead) * (part + 1) // 4
        keys.append((part, n, tuple(tokens[:a]), tuple(tokens[b:])))
    return keys


def cut_lines(docs, documents=3, pair=None):
    """(text, number of lines cut) of each document that stays, by row."""

    def enough(k):
        return 2 if pair is not None and k[0] == -1 and k[1] >= pair else documents

    owner = {}
    for key, text in docs:
        rank = (key is None, key or 0)
        owner[text] = min(owner.get(text, rank), rank)
    having, first = defaultdict(set), {}
    for _, text in docs:
        for at, line in enumerate((text or "").split("\n")):
            for k in template_keys(line):
                having[k].add(text)
                first[k] = min(first.get(k, (owner[text], at)), (owner[text], at))
    out = []
    for key, text in docs:
        parts = (text or "").split("\n")
        gone = [
            any(len(having[k]) >= enough(k) and first[k] != (owner[text], at) for k in template_keys(line))
            for at, line in enumerate(parts)
        ]
        kept = "\n".join(p for p, g in zip(parts, gone, strict=True) if not g)
        if not any(gone):
            out.append((key, text, 0))
        elif kept.strip(" \t\n\x0b\f\r"):
            out.append((key, kept, sum(gone)))
    return out


def as_bag(rows):
    return sorted(map(repr, rows))


def test_lines_equal_brute_force(make, edges):
    notice = "this page was made on 2020-01-0{} by the team of the site and its many friends {} all of you"
    docs = [*edges]
    for i in range(12):
        own = prose(100 + i, 15)
        docs.append((100 + i, f"{own}\n{notice.format(i, 'near' if i % 2 else 'far')}\nshort one\nexactly these words\n{prose(300 + i, 8)}"))
    docs.append((200, "exactly these words\n" + notice.format(7, "near")))  # nothing is left of it
    docs += [(201 + i, docs[12][1]) for i in range(5)]  # whole copies are no templates
    got = lines.drop_recurring(make(docs), dropped="n_chars")
    assert got.columns.count("n_chars") == 1
    want = cut_lines(docs)
    assert as_bag((r.doc_id, r.text, r.n_chars) for r in got.collect()) == as_bag(want)
    assert len(want) == len(docs) - 1
    assert lines.drop_recurring(make([])).count() == 0


def test_lines_leave_clean_documents_alone(make):
    docs = [(i, f"{prose(i, 20)}\n{prose(500 + i, 30)}") for i in range(40)]
    assert as_bag((r.doc_id, r.text) for r in lines.drop_recurring(make(docs)).collect()) == as_bag(docs)


def test_op2_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [(r.doc_id, r.text, r.n_dropped) for r in queries.op2_line_dedup(spark, SF).collect()]
    assert as_bag(got) == as_bag(cut_lines(docs, pair=12))


def test_a_long_line_of_two_texts_goes_from_the_later(make):
    passage, short = prose(7, 60), prose(8, 11)
    docs = [(i, f"{prose(10 + i, 30)}\n{passage}\n{short}\n{prose(20 + i, 40)}") for i in (3, 1)]
    docs += [(5, docs[0][1]), (6, f"{prose(30, 20)}\n{passage.replace(' ', ' 7 ', 1)}")]  # a copy, and another line
    got = lines.drop_recurring(make(docs), dropped="n", pair=12).collect()
    assert {r.doc_id: r.n for r in got} == {1: 0, 3: 1, 5: 1, 6: 0}
    assert as_bag((r.doc_id, r.text, r.n) for r in got) == as_bag(cut_lines(docs, pair=12))
    assert as_bag((r.doc_id, r.text) for r in lines.drop_recurring(make(docs)).collect()) == as_bag(docs)
    alone = [(1, f"{passage}\n{passage}\n{prose(9, 20)}")]  # one text is never enough
    assert as_bag((r.doc_id, r.text) for r in lines.drop_recurring(make(alone), pair=12).collect()) == as_bag(alone)


def test_long_lines_of_few_tokens_recur(make):
    passage, menu = "文書の中で空白なしに書かれた長い一節はこのように続いていく2019年", "Home page"
    docs = [(i, f"{prose(i, 20)}\n{passage}\n{menu}") for i in range(4)]
    got = lines.drop_recurring(make(docs), characters=20, dropped="n")
    assert {r.doc_id: r.n for r in got.collect()} == {0: 0, 1: 1, 2: 1, 3: 1}
    other = [(i, f"{prose(i, 20)}\n{passage}{i}") for i in range(4)]  # digits are no field here
    assert as_bag((r.doc_id, r.text) for r in lines.drop_recurring(make(other), characters=20).collect()) == as_bag(other)


def test_rows_of_numbers_recur_only_when_equal(make):
    wide = " ".join(str(i) for i in range(14))
    docs = [(i, f"{prose(i, 20)}\n12 4.5 20{i}\n{wide} {i}\n{wide} a {i}\n7 8 9") for i in range(4)]
    got = {r.doc_id: r.text for r in lines.drop_recurring(make(docs), constants=True).collect()}
    want = {i: t if i == 0 else t.removesuffix("\n7 8 9") for i, t in docs}
    want = {i: t if i == 0 else t.replace(f"\n{wide} a {i}", "") for i, t in want.items()}
    assert got == want


# Near duplicates


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def link_components(docs, size, percent):
    """(key, number of shingles, component, kept) of each row."""
    sets = [shingle_set(text, size) for _, text in docs]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in where[x]:
                shared[j] += j > i
        for j, n in shared.items():
            if n and 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(j)] = root(i)
    least = {}
    for i, (key, _) in enumerate(docs):
        rank = (key is None, key)
        least[root(i)] = min(least.get(root(i), rank), rank, key=lambda r: (r[0], r[1] or 0))
    return [(k, len(sets[i]), least[root(i)][1], k == least[root(i)][1]) for i, (k, _) in enumerate(docs)]


def test_near_duplicates_equal_brute_force(make, edges):
    docs, draw = [*edges], random.Random(9)
    for g in range(12):
        base = prose(40 + g, draw.choice([6, 12, 40, 150])).split()
        for i in range(draw.choice([1, 3, 12])):
            words = [*base]
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
                words[draw.randrange(len(words))] = f"w{draw.randrange(5)}"
            docs.append((1000 + 100 * g + i, " ".join(words)))
    draw.shuffle(docs)
    for size in (4, 5):
        got = neardup.components(make(docs), size=size).collect()
        assert as_bag((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == as_bag(link_components(docs, size, 80))
    assert neardup.components(make([])).count() == 0


def test_links_without_the_centre_are_found(make):
    """A chain of variants: most pairs share buckets, few are links, all of them are found."""
    base = prose(77, 60).split()
    docs = []
    for i in range(30):
        words = [*base]
        words[2 * i : 2 * i + 2] = ["x", "y"]
        docs.append((i, " ".join(words)))
    docs += [(100 + i, docs[i][1] + " z") for i in range(30)]
    got = neardup.components(make(docs), size=4).collect()
    assert as_bag((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == as_bag(link_components(docs, 4, 80))


def test_op9_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in queries.op9_minhash(spark, SF).collect()]
    assert as_bag(got) == as_bag(link_components(docs, 4, 80))


def test_small_sets_borrow_like_large_ones():
    """The share of equal signature values follows the similarity, for sets smaller than the bins."""
    draw, equal = np.random.default_rng(1), []
    for _ in range(200):
        union = np.unique(draw.integers(0, 1 << 64, 10, np.uint64))
        a, b = neardup.signature(union[:9], 128), neardup.signature(union[1:], 128)
        equal.append((a == b).mean())
    assert abs(np.mean(equal) - 0.8) < 0.03


# Search


def best(vectors, asked, k):
    whole = {}
    rows = []
    for key, vector in vectors:
        if key is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            rows.append((key, [int(np.floor(1024 * float(np.float32(x)))) for x in vector]))
    out = []
    for q, a in rows:
        if not asked(q):
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), key) for key, b in rows if key != q and len(a) == len(b))
        whole.setdefault((q, tuple(a)), found[:k])
    for (q, _), found in whole.items():
        out += [(q, i + 1, key, -score) for i, (score, key) in enumerate(found)]
    return out


@pytest.mark.parametrize("block", [2048, 3])
def test_search_equals_brute_force(spark, block):
    draw = random.Random(2)
    vectors = [(i, [draw.uniform(-1, 1) for _ in range(5)]) for i in range(300)]
    vectors += [(1000 + i, [0.5] * 5) for i in range(200)]  # ties
    vectors += [(5000, None), (5100, [1.0, None, 0.0, 0.0, 0.0]), (5200, [1.0, float("nan"), 0.0, 0.0, 0.0]), (None, [1.0] * 5)]
    vectors += [(5300, [1.0, 2.0]), (5400, [3.0, 1e4]), (5500, []), (5600, [float("inf")] * 5)]
    vectors += [vectors[0], vectors[7]]
    df = spark.createDataFrame([(k, v, "r") for k, v in vectors], "vec_id long, embedding array<float>, rank string")
    got = topk.search(df, df.where("vec_id % 100 = 0"), k=10, block=block)
    want = best(vectors, lambda k: k % 100 == 0, 10)
    assert as_bag(tuple(r) for r in got.collect()) == as_bag(want)
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    vectors = [(i, [float(np.float32(2e4 * (i + 1) + 0.1)), float(np.float32(-7e5 / (i + 1))), 1e5]) for i in range(40)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = topk.search(df, df.where("vec_id % 10 = 0"), k=5)
    assert as_bag(tuple(r) for r in got.collect()) == as_bag(best(vectors, lambda k: k % 10 == 0, 5))


# Archives


def base32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PAGES = [
    (1, "http://a/ü", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "http://c\r\nX: y", ""),
    (5, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (6, "u", "x" * 300_000), (7, "u", "x" * 300_000), (8, "u", "\r\n\r\n"),
    (None, "n", "only here"), (None, "n", "<p>é</p>"), (9, "u", "twice"), (9, "u", "twice"),
]


@pytest.mark.parametrize("compression", ["gzip", "none"])
@pytest.mark.parametrize("least", [0, 8])
def test_archive_round_trip(spark, tmp_path, compression, least):
    pages = spark.createDataFrame([(*p, "t") for p in PAGES], "page_id long, url string, html string, record_type string")
    path = f"file://{tmp_path}/archive"
    back = warc.round_trip(pages, path, least_bytes=least, compression=compression)
    first = {}
    for key, _, html in PAGES:
        payload = (html or "").encode()
        if key is not None and len(payload) >= least:
            first[payload] = min(first.get(payload, key), key)
    want = []
    for key, _, html in PAGES:
        payload = (html or "").encode()
        to = first.get(payload)
        again = to is not None and to != key
        want.append((None if key is None else str(key), len(payload), base32(payload), "revisit" if again else "response", str(to) if again else None))
    assert as_bag(tuple(r) for r in back.collect()) == as_bag(want)
    payloads = {r.payload.decode() for r in warc.read(spark, path).where("record_type = 'response'").collect()}
    assert payloads == {html or "" for _, _, html in PAGES}


def test_archive_predicates_are_pushed(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = f"file://{tmp_path}/archive"
    warc.write(pages, path)
    revisits = warc.read(spark, path).where("record_type = 'revisit' AND target_uri IN ('http://b', 'u')")
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]
    assert {r.target_uri for r in revisits.collect()} == {"http://b", "u"}
    assert warc.read(spark, path, payload=False).where("payload IS NOT NULL").isEmpty()
    assert warc.read(spark, path).where("length(target_uri) = 1 AND record_type <> 'revisit'").count() == 6


def test_archive_of_an_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages, f"file://{tmp_path}/archive").count() == 0


def test_reader_skips_unwanted_blocks():
    class Source:
        """Counts the bytes that are read."""

        def __init__(self, content):
            import io

            self.inner, self.read_bytes = io.BytesIO(content), 0

        def readline(self, n=-1):
            line = self.inner.readline(n)
            self.read_bytes += len(line)
            return line

        def read(self, n):
            self.read_bytes += n
            return self.inner.read(n)

        def seek(self, *a):
            return self.inner.seek(*a)

    record = b"WARC/1.1\r\nWARC-Type: %s\r\nContent-Length: 100000\r\n\r\n" + b"x" * 100_000 + b"\r\n\r\n"
    source = Source(record % b"resource" + record % b"response")
    found = list(warc.records(source, lambda h: h["warc-type"] == "response", False))
    assert len(found) == 1 and source.read_bytes < 1000


# Mixing


def targets_of(sizes, share=1.5, most=2.0):
    """Targets by source, names in order, null last."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        left = budget - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * left / open_weight > most * sizes[s]} if open_weight else set()
        if not more:
            return {s: most * sizes[s] if s in full else weight[s] * left / open_weight for s in names}
        full |= more


@pytest.fixture(scope="module")
def sourced():
    draw = random.Random(4)
    docs = [(i, prose(i, draw.choice([0, 1, 5, 30, 200])), draw.choice(["a", "b", "c", "é", "z", None, "b"])) for i in range(400)]
    return [*docs, (1000, None, "a"), (1001, "", "empty"), (None, "no id", "b"), docs[3], docs[5]]


@pytest.mark.parametrize("bucket_rows", [20_000, 7])
def test_mix(make, sourced, bucket_rows):
    docs = make(sourced)
    rows = mixing.mix(docs, bucket_rows=bucket_rows).collect()
    assert len(rows) == len(sourced)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in sourced:
        sizes[source] += len((text or "").split())
    want = targets_of(sizes)
    largest = max(len((t or "").split()) for _, t, _ in sourced)
    for row in rows:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(want[row.source])
        assert row.copies in ({0} if row.size == 0 else {int(row.target / row.source_size), int(row.target / row.source_size) + 1})
        taken[row.source] += row.copies * row.size
    for source, target in want.items():
        assert abs(taken[source] - target) <= 2 * largest
    again = mixing.mix(docs.repartition(5), bucket_rows=bucket_rows).collect()
    assert as_bag(map(tuple, rows)) == as_bag(map(tuple, again))


def test_rounding_keeps_expectations():
    draw = random.Random(8)
    total = np.zeros(3)
    for _ in range(4000):
        chances, sizes, held = [0.3, 0.6, 0.45], [10, 30, 7], 0
        for i in (1, 2):
            held = i if held < 0 else mixing.pair(chances, sizes, held, i, draw.random())
        if held >= 0:
            chances[held] = float(draw.random() < chances[held])
        assert set(chances) <= {0.0, 1.0}
        total += chances
    assert np.allclose(total / 4000, [0.3, 0.6, 0.45], atol=0.03)


def test_repeat(make, sourced):
    docs = make(sourced)
    mixed = mixing.mix(docs)
    want = sum(r.copies for r in mixed.collect())
    out = mixing.repeat(docs, mixed)
    assert out.columns == docs.columns
    assert out.count() == want
    assert mixing.mix(make([])).count() == 0


# Pipeline


def test_quality_stage_leaves_no_texts_on_disk(spark, make):
    """The same rows as from one measurement, without a copy of the texts, and measured once for the result."""
    raw = make([(i, prose(i, 40 + i)) for i in range(90)] + [(None, prose(5, 60)), (90, None), (91, "### $$$ " * 60)])
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    want = quality.judge(quality.measure(raw)).where("kept").select(*raw.columns).collect()
    before = set(root.glob("quality-rows-*"))
    kept = corpus_pipeline.keep_quality(spark, raw, SF)
    assert as_bag(map(tuple, kept.collect())) == as_bag(map(tuple, want)) and len(want) > 50
    assert set(root.glob("quality-rows-*")) == before
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("ArrowEvalPython") == 1


def test_pipeline_stages(spark, make, edges):
    """Each stage against a plain version, on the stage's own input."""
    notice = "this page was made by the team of the site and its many friends for all of you"
    docs, odd = [(i, t, "s") for i, t in edges], "### $$$ %%% " * 40
    for i in range(90):
        docs.append((100 + i, f"{prose(100 + i, 80)}\n{notice}\n{prose(900 + i, 40)}", "ab"[i % 2]))
    docs += [(300 + i, docs[20][1].replace("e", "e", 1), "a") for i in range(3)]
    docs += [(400, docs[21][1] + " tail", "b"), (401, prose(5, 60) + odd, "a")]
    raw = make(docs)
    columns = raw.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "minhash", "mixing", "sentencepiece"]

    good = stages["quality_rules"](spark, raw, SF).cache()
    assert good.columns == columns
    ids = {r.doc_id for r in good.collect()}
    assert 401 not in ids and set(range(100, 190)) <= ids
    assert all(quality.statistics_of(r.text)[0] >= 50 for r in good.collect())

    cut = stages["line_dedup"](spark, good, SF).cache()
    assert cut.columns == columns
    want = cut_lines([(r.doc_id, r.text) for r in good.collect()])
    assert as_bag((r.doc_id, r.text) for r in cut.collect()) == as_bag((k, t) for k, t, _ in want)
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    unique = stages["minhash"](spark, cut, SF).cache()
    assert unique.columns == columns
    rows = [(r.doc_id, r.text) for r in cut.collect()]
    kept = {(k, t) for (k, t), (*_, keep) in zip(rows, link_components(rows, 5, 80), strict=True) if keep}
    assert as_bag((r.doc_id, r.text) for r in unique.collect()) == as_bag(kept)

    mixed = stages["mixing"](spark, unique, SF).cache()
    assert mixed.columns == columns
    numbers = {(r.doc_id, r.source): r.copies for r in mixing.mix(unique).collect()}
    assert mixed.count() == sum(numbers.values())

    coded = stages["sentencepiece"](spark, mixed, SF)
    assert "ids" in coded.columns and coded.count() == mixed.count()


def test_pipeline_survives_an_empty_table(spark, make):
    docs = make([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_run_equals_its_stages(spark, make, tmp_path):
    """``run`` gives what the stages give one after the other, and leaves only the last table."""
    page = [(i, f"{prose(i, 90)}\n{prose(5, 14)}\n{prose(40 + i, 60)}", "ab"[i % 2]) for i in range(1, 70)]
    docs = make([*page, (70, page[0][1], "a"), (71, "short", "b"), (72, None, "b")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    root = scratch_root(spark)
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    got = corpus_pipeline.run(spark, str(tmp_path))
    left = {name for name in set(os.listdir(root)) - before if name.startswith("pipeline-")}
    assert [name.rsplit("-", 1)[0] for name in left if "unique" not in name] == ["pipeline-sentencepiece"]
    want = docs
    for _, stage in corpus_pipeline.STAGES:
        want = stage(spark, want, str(tmp_path))
    assert got.columns == want.columns
    rows = got.collect()
    assert {71, 72}.isdisjoint(r.doc_id for r in rows) and len({r.doc_id for r in rows} & {1, 70}) < 2
    assert sorted(map(str, rows)) == sorted(map(str, want.collect()))


def test_pipeline_cuts_long_lines_of_two_documents(spark, make):
    """A long line of two different texts goes from the later one; near-duplicates go whole, not in parts."""
    shared, short = prose(1, 30), "a short line of two"
    docs = [(i, f"{prose(10 + i, 80)}\n{shared}\n{short}\n{prose(20 + i, 40)}") for i in (1, 2)]
    base = prose(50, 90)
    docs += [(3, f"{base}\n{prose(51, 60)}"), (4, f"{base}\n{prose(51, 60)} tail")]
    stages, left = dict(corpus_pipeline.STAGES), make(docs)
    for name in ("line_dedup", "minhash"):
        left = stages[name](spark, left, SF)
    want = [docs[0], (2, docs[1][1].replace(f"{shared}\n", "")), docs[2]]
    rows = left.collect()
    assert as_bag((r.doc_id, r.text) for r in rows) == as_bag(want)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_pipeline_near_duplicates_with_shared_and_null_ids(spark, make):
    """Rows of one id are judged one by one; of near-duplicates without ids one stays."""
    a, b, c = (prose(60 + i, 90) for i in range(3))
    docs = [(1, a), (2, f"{a} tail"), (2, b), (None, c), (None, f"{c} tail"), (None, c, "other")]
    got = dict(corpus_pipeline.STAGES)["minhash"](spark, make(docs), SF).collect()
    assert as_bag((r.doc_id, r.text) for r in got if r.doc_id) == as_bag([(1, a), (2, b)])
    assert len(got) == 3
