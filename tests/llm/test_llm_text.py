"""Row operators: pieces, licences, secrets, quality statistics, toxicity."""

from __future__ import annotations

import hashlib
import random
import re
import string
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_texts import SF, prose
from sentencepiece import sentencepiece_model_pb2 as pb

from txnrisk.llm import licenses, pieces, quality, queries, secrets, toxicity

MODEL_FILE = queries.piece_model()


@pytest.fixture(scope="module")
def model():
    with open(MODEL_FILE, "rb") as f:
        return pieces.Model(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)


def unigram(byte_fallback: bool) -> bytes:
    """A unigram model from a hand-written list of pieces; nothing is trained."""
    spec = pb.ModelProto()
    spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
    spec.trainer_spec.byte_fallback = byte_fallback
    spec.normalizer_spec.name = "identity"
    spec.normalizer_spec.add_dummy_prefix = True
    spec.normalizer_spec.remove_extra_whitespaces = False
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        listed += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    scored = {"▁": -3.1, "a": -3.3, "b": -3.7, "c": -4.1, "ab": -5.3, "bc": -5.9, "abc": -7.7, "▁a": -4.4, "▁ab": -6.1, "cc": -6.6, "▁▁": -5.05}
    listed += [(p, s, 1) for p, s in scored.items()]
    for piece, score, kind in listed:
        spec.pieces.add(piece=piece, score=score, type=kind)
    return spec.SerializeToString()


@given(st.text(alphabet="ab the\n\t=-#*日é😀▁", max_size=80))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_library(model, library, text):
    ids = pieces.encode_text(model, text)
    assert ids == library.encode(text)
    assert pieces.decode_ids(model, ids) == text.replace("▁", " ")


@pytest.mark.parametrize("byte_fallback", [True, False])
@given(text=st.text(alphabet="abc xé", max_size=60))
@settings(max_examples=200, deadline=None)
def test_unigram_ids_equal_the_library(byte_fallback, text):
    serialized = unigram(byte_fallback)
    own, library = pieces.Model(serialized), sentencepiece.SentencePieceProcessor(model_proto=serialized)
    assert own.kind == "unigram"
    ids, want = pieces.encode_text(own, text), library.encode(text)
    if ids != want:  # the same pieces in another order have the same sum
        assert sum(own.scores.get(i, 0) for i in ids) == pytest.approx(sum(own.scores.get(i, 0) for i in want))
        assert sorted(ids) == sorted(want) and library.decode(ids) == library.decode(want)


def test_ids_come_in_runs_from_a_bounded_window(model, library):
    text = "▁" + "".join(random.Random(5).choices("abcdeth", k=20_000))
    runs = list(pieces.stream(model, text))
    assert len(runs) > 100
    assert max(map(len, runs)) < 200
    assert [i for run in runs for i in run] == library.encode(text[1:])


def test_encode_whole_table(spark, make, edges, library):
    docs = make(edges)
    coded = pieces.encode(docs, MODEL_FILE)
    assert [c for c in coded.columns if c == "ids"] == ["ids"]
    back = pieces.decode(coded, MODEL_FILE, text="decoded").collect()
    assert len(back) == len(edges)
    for row in back:
        assert row.ids == library.encode(row.text or "")
        assert row.decoded == (row.text or "")
    assert pieces.encode(make([]), MODEL_FILE).count() == 0


def test_op1_gives_every_text_back(spark):
    assert queries.op1_sentencepiece(spark, SF).where("NOT round_trip OR n_ids = 0").isEmpty()


def base_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES:
        wanted = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(wanted)] == wanted:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


@given(st.lists(st.sampled_from("under the MIT license apache version 2 cc BY nc é _ , . \n 2.0 -".split(" ")), max_size=30))
@settings(max_examples=300, deadline=None)
def test_license_base_equals_brute_force(tokens):
    for glue in (" ", "-", "\n"):
        text = glue.join(tokens)
        assert licenses.scan_text(text)[0][:5] == base_license(text)


def test_fuzzy_notices():
    found = licenses.fuzzy_spans("x released undr the mit lcense. y")
    assert [s[0] for s in found] == ["mit"]
    assert found[0][3] == 2
    assert licenses.fuzzy_spans("the quick brown fox and all that") == []
    fields, _ = licenses.scan_text("Licensed under the GNU General Public License, version 3.")
    assert fields[5] == "gpl-3" and fields[1] == 0 and 0 < fields[6] <= 1


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@given(st.data())
@settings(max_examples=400, deadline=None)
def test_seeds_lose_no_notice(data):
    """A notice with few enough substitutions, insertions and deletions outside of its core is always found."""
    notice, label, errors, core = data.draw(st.sampled_from(licenses.NOTICES))
    text, kept = list(notice), notice.find(core) if core else -1
    for _ in range(data.draw(st.integers(0, errors))):
        at = data.draw(st.integers(0, len(notice) - 1))
        if not (core and kept - 1 <= at <= kept + len(core)):
            text[at] = data.draw(st.sampled_from(["z", "", text[at] + "q"]))
    text = "".join(text)
    lead = data.draw(st.sampled_from(["lead ", "", "see license. under the public license, "]))
    spans = licenses.fuzzy_spans(f"{lead}{text} tail")
    distance = edit_distance(notice, text)
    assert distance <= errors
    over = [s for s in spans if s[1] < len(lead) + len(text) and s[2] > len(lead)]
    # The notice itself, or a closer one in its place.
    assert any(s[0] == label and s[3] <= distance for s in over) or any(s[3] <= distance for s in over)


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("licensed under cc by-sa 4.0", "cc-by-sa"), ("licensed undr cc by-nd 4.0", "cc-by-nd"), ("licensed under cc by-nc-sa 4.0", "cc-by-nc-sa"),
        ("licensed under cc by-nc 4.0", "cc-by-nc"), ("licensed under cc by 4.0", "cc-by"), ("licensed under cc by-na 4.0", None),
        ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2"), ("spdx-licence-identifier: BSD-3-Clause", "bsd-3-clause"),
        ("Creative Commons Attribution-NonComercial", None), ("Creative Commons Atribution-NonCommercial", "cc-by-nc"),
        ("creative commons attribution-noncommercial-sharealike", "cc-by-nc-sa"), ("CC0 1.0 Universal", "cc0"),
        ("Eclipse Public Licence, Version 2.0", "epl-2"), ("This is free and unencumbered sofware released into the public domain", "unlicense"),
        ("Neither the name of the copyright holder nor the names of its contributers", "bsd-3-clause"),
    ],
)
def test_neighbouring_licences_are_told_apart(text, label):
    assert {s[0] for s in licenses.fuzzy_spans(f"It is {text}.".lower())} == ({label} if label else set())


def test_dense_notices_take_time_by_length():
    """A megabyte of notices, of notices with edits, and of words that notices begin with."""
    import time

    for text, n in [
        ("released under the mit license. ", 1), ("licensed undr the gnu general public license, version 2, and all rigths reserved. ", 1),
        ("public license ", 0), ("licensed under the ", 0),
    ]:
        times = 1_000_000 // len(text)
        began = time.process_time()
        assert len(licenses.fuzzy_spans(text * times)) >= n * times
        assert time.process_time() - began < 60  # a few seconds; quadratic time would be hours


def test_closer_notices_do_not_hide_earlier_ones():
    """Places of one notice whose windows meet are all found, whatever their edits."""
    far, near = "released undr the mit lcense.", "released under the mit license."
    between = " see license. see license. see license. "
    text = far + between + near
    at = text.index(near)
    spans = [s for s in licenses.fuzzy_spans(text) if s[0] == "mit"]
    assert [(s[1], s[2], s[3]) for s in spans] == [(0, 28, 2), (at, at + 30, 0)]
    text = far + " " + near + " " + far
    assert [s[3] for s in licenses.fuzzy_spans(text) if s[0] == "mit"] == [2, 0, 2]
    gpl = "licensed under the gnu general public license, "
    fields, _ = licenses.scan_text(f"{gpl}versoin 2 {gpl}version 3")
    assert fields[5] == "gpl-2,gpl-3"


def test_license_scan_whole_table(spark, make, edges):
    rows = licenses.scan(make(edges)).collect()
    assert len(rows) == len(edges)
    for row in rows:
        assert tuple(row[f] for f in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == base_license(row.text)
    assert licenses.scan(make([])).count() == 0


def base_secrets(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [("assign", *m.span()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 8]
    spans += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    kinds = [k for k, _, _ in spans]
    spans.sort(key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(joined.encode()).hexdigest(), joined


SECRET_PARTS = ["PassWord", "token", "api_key", "=", ": ", '"', "AKIA", "ABCDEFGHIJKL", "0123456789abcdef", "x", "\n", "ſecret", "secret", "K", "é"]


@given(st.lists(st.sampled_from(SECRET_PARTS), max_size=20))
@settings(max_examples=400, deadline=None)
def test_secret_base_equals_brute_force(parts):
    text = "".join(parts)
    got, want = secrets.scan_text(text), base_secrets(text)
    assert got[:4] == want[:4]
    assert set(filter(None, want[4].split(","))) <= set(got[4].split(","))


def test_novelty():
    key = "Zq8vT1xLw93KfYb2RmUo5Hd7"
    assert secrets.novel_spans(f"the bearer {key} here", 40, 256, 4.5) == [("novel", 11, 11 + len(key))]
    assert secrets.novel_spans("password your_password_here_1234567890", 40, 256, 4.5) == []
    assert secrets.novel_spans(f"{key} password {key}", 40, 256, 4.5) == []  # its surroundings hold it
    assert secrets.novel_spans(f"plain words {key}", 40, 256, 4.5) == []


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"])
def test_novelty_of_keys_of_one_kind_of_character(alphabet):
    draw = random.Random(4)
    for _ in range(200):
        key = "".join(draw.choices(alphabet, k=24))
        assert secrets.novel_spans(f"Bearer {key}", 40, 256, 4.5) == [("novel", 7, 31)]


def test_novelty_before_a_sensitive_word():
    key = "Zq8vT1xLw93KfYb2RmUo5Hd7"
    assert secrets.novel_spans(f"use {key} as token", 40, 256, 4.5) == [("novel", 4, 28)]
    assert secrets.novel_spans(f"use {key}_token", 40, 256, 4.5) == [("novel", 4, 29)]
    other = key[::-1]
    assert secrets.novel_spans(f"{other} token {key}", 40, 256, 4.5) == [("novel", 0, 24), ("novel", 31, 55)]
    assert secrets.novel_spans(f"{key} {'far ' * 20} token", 40, 256, 4.5) == []
    for word in ("internationalization", "characterization", "desafortunadamente"):
        assert secrets.novel_spans(f"the {word} of a token", 40, 256, 4.5) == []


# Rare words, identifiers and places, none of them a key.
PLAIN_TOKENS = [
    "disenfranchisement", "electroencephalogram", "counterrevolutionaries", "AuthenticationManagerBuilder",
    "internationalization", "characterization", "desafortunadamente", "interoperability_and_standards",
    "en.wikipedia.org/wiki/Public-key_cryptography", "src/main/java/org/example/AuthenticationFilter.java",
    "constitutionally-guaranteed", "anticonstitutionnellement", "telecommunications",
]


def test_words_near_a_sensitive_word_are_no_secrets():
    ranks = secrets.read_ranks(queries.byte_pairs())
    for word in PLAIN_TOKENS:
        for text in (f"the {word} of a token", f"password {word}", f"{word} secret"):
            assert secrets.novel_spans(text, 40, 256, 4.5, ranks=ranks) == [], text


@pytest.mark.parametrize("alphabet", [string.ascii_lowercase, string.ascii_uppercase, string.digits, string.ascii_letters + string.digits + "+/"])
@pytest.mark.parametrize("length", [20, 24, 40])
def test_random_keys_are_found_with_the_vocabulary(alphabet, length):
    draw, ranks = random.Random(5), secrets.read_ranks(queries.byte_pairs())
    for _ in range(200):
        key = "k" + "".join(draw.choices(alphabet, k=length - 1))
        assert secrets.novel_spans(f"Bearer {key}", 40, 256, 4.5, ranks=ranks) == [("novel", 7, 7 + length)]


def test_tokens_of_the_corpus_are_familiar(make):
    """A token that stands in several contexts is known; a key in any number of copies is not."""
    name, key = "Bundesverfassungsgericht", "Zq8vT1xLw93KfYb2RmUo5Hd7"
    docs = [(i, f"{prose(i, 4)} {name} {prose(50 + i, 4)} the far away part of a long enough text") for i in range(5)]
    docs += [(10 + i, f"bearer {key} {prose(70 + i, 3)}") for i in range(30)]
    docs += [(50, f"the secret {name} of"), (51, None), (52, ""), (53, "0" * 40)]
    known = {r.token: r.n for r in secrets.familiar_tokens(make(docs)).collect()}
    assert known == {name: 5}
    assert secrets.familiar_tokens(make(docs), contexts=6).count() == 0
    assert secrets.familiar_tokens(make(docs), contexts=1, most=1).count() == 1
    spans = {r.doc_id: r.spans for r in secrets.scan(make(docs)).collect()}
    assert spans[50] == "" and {spans[10 + i] for i in range(30)} == {"novel:7:31"}
    assert secrets.scan(make(docs), contexts=100).where("doc_id = 50").first().spans == "novel:11:35"
    assert secrets.familiar_tokens(make([])).count() == 0


def test_long_runs_of_one_token_take_linear_time():
    started = time.process_time()
    secrets.uses("token " + "ab12" * 200_000 + " " + "wordwordwordword " * 40_000, 40)
    assert time.process_time() - started < 5


def test_read_ranks_refuses_large_files(tmp_path):
    (tmp_path / "ranks").write_bytes(b"x" * 11)
    with pytest.raises(ValueError, match="larger than 10"):
        secrets.read_ranks(str(tmp_path / "ranks"), 10)


def test_op10_base_on_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op10_secret_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = base_secrets(texts[row.doc_id] or "")
        assert (row.n_assign, row.n_access, row.n_hex, row.base_sha256) == want[:4]
        assert set(filter(None, want[4].split(","))) <= set(row.spans.split(","))


def test_secret_scan_whole_table(make, edges):
    rows = secrets.scan(make(edges)).collect()
    assert len(rows) == len(edges)
    for row in rows:
        assert (row.n_assign, row.n_access, row.n_hex, row.base_sha256) == base_secrets(row.text or "")[:4]
    assert secrets.scan(make([])).count() == 0


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


@given(st.lists(st.sampled_from(["a", "b", "c", "\n", "#", "é ", " ", "\x0b"]), max_size=60), st.sampled_from([" ", "\n", ""]))
@settings(max_examples=400, deadline=None)
def test_statistics_equal_brute_force(tokens, glue):
    text = glue.join(tokens)
    assert quality.statistics_of(text) == brute_statistics(text)


def test_quality_whole_table(spark, make, edges):
    rows = quality.judge(quality.measure(make(edges))).collect()
    assert len(rows) == len(edges)
    for row in rows:
        want = brute_statistics(row.text)
        assert tuple(row[n] for n in quality.STATISTICS) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert row.base_failed == failed
        assert row.kept == (not failed)  # too few rows for an estimate
    assert quality.judge(quality.measure(make([]))).count() == 0


def test_outliers_go_and_regular_rows_stay(spark, make):
    rows = [(i, prose(i, 120), None if i % 2 else "s") for i in range(200)]
    odd = [(1000 + i, prose(900 + i, 100) + " ### $$$ %%% &&&" * 20, "s") for i in range(8)]
    judged = quality.judge(quality.measure(make(rows + odd))).collect()
    assert {r.doc_id for r in judged if not r.kept} == {i for i, _, _ in odd}
    assert all(r.distance is not None for r in judged)


def least_determinant(data, scales, share):
    """Over all subsets of the least allowed size: logarithm of the least determinant, and its mean."""
    size = -(-int(share * 100) * len(data) // 100)
    found = []
    for chosen in combinations(range(len(data)), size):
        part = data[list(chosen)]
        found.append((np.linalg.slogdet(np.cov(part.T, bias=True) + np.diag(np.square(scales)))[1], tuple(part.mean(0))))
    return min(found)


def test_estimate_is_the_least_determinant_of_all_subsets(spark):
    """Small pools with a cluster of outliers, against every subset of nine of twelve rows."""
    names, scales = ["x", "y"], [10.0, 10.0]
    data, rows = {}, []
    for pool in range(12):
        draw = np.random.default_rng(pool)
        part = draw.multivariate_normal([1000, 2000], [[9000, 5000], [5000, 16000]], 12).round().astype(int)
        part[:3] = draw.multivariate_normal([1000 + 900 * (pool % 3), 4000], [[2000, 0], [0, 2000]], 3).round()
        data[f"p{pool}"] = part
        rows += [(f"p{pool}", int(x), int(y)) for x, y in part]
    vectors = spark.createDataFrame(rows, "pool string, x long, y long")
    found = {r.pool: r for r in quality.estimates(vectors, names, scales, 0.75, 20, 10, bins=4096, least_step=1e-9).collect()}
    assert found.keys() == data.keys()
    for pool, part in data.items():
        det, mean = least_determinant(part, scales, 0.75)
        assert found[pool].det == pytest.approx(det, rel=1e-6)
        assert found[pool].mean == pytest.approx(mean, rel=1e-6)


def test_estimate_is_its_own_concentration_step(spark):
    """Where it has settled, the nearest rows under an estimate give that estimate again."""
    names, scales = ["x", "y"], [10.0, 10.0]
    draw = np.random.default_rng(3)
    data = draw.multivariate_normal([1000, 2000], [[900, 500], [500, 1600]], 400).round().astype(int)
    data[:40] += 4000
    rows = spark.createDataFrame([("p", int(x), int(y)) for x, y in data], "pool string, x long, y long")
    found = quality.estimates(rows, names, scales, 0.75, 30, 10, bins=4096, least_step=1e-9).first()
    mean = np.array(found["mean"])
    assert np.allclose(mean, [1000, 2000], atol=15)
    a, b, c = found["inverse"]
    inverse = np.array([[a, b], [b, c]])
    gap = data - mean
    distance = np.einsum("ij,jk,ik->i", gap, inverse, gap)
    kept = data[distance <= np.sort(distance)[299]]
    covariance = np.cov(kept.T, bias=True) + np.diag(np.square(scales))
    assert np.allclose(inverse, np.linalg.inv(covariance), rtol=1e-6)
    assert found["det"] == pytest.approx(np.linalg.slogdet(covariance)[1], rel=1e-6)
    assert distance[:40].min() > 100 * np.median(distance)
    again = quality.estimates(rows.repartition(7), names, scales, 0.75, 30, 10, bins=4096, least_step=1e-9).first()
    assert again == found


def test_estimates_of_equal_and_few_rows(spark):
    """Pools without any spread have an estimate by the least deviations; small pools have none."""
    rows = [("same", 5, 5)] * 20 + [("few", i, i) for i in range(9)]
    vectors = spark.createDataFrame(rows, "pool string, x long, y long")
    found = quality.estimates(vectors, ["x", "y"], [2.0, 3.0], 0.75, 5, 10).collect()
    assert [r.pool for r in found] == ["same"]
    assert found[0].mean == [5.0, 5.0]
    assert found[0].det == pytest.approx(np.log(36))


def test_toxicity_beats_chance_on_held_out_rows(spark):
    scored = queries.op6_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    ones = [r.score for r in rows if r.toxic == 1]
    zeros = [r.score for r in rows if r.toxic == 0]
    auc = np.mean([(a > b) + (a == b) / 2 for a in ones for b in zeros])
    assert auc > 0.75
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_toxicity_equals_numpy(spark):
    """Ratios, and the score of a text, by plain counting over its distinct n-grams."""
    texts = [(prose(i, 12) + (" zounds" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(60)]
    scratch = np.zeros(toxicity.BUCKETS, bool)
    sets = [set(toxicity.buckets_of(t, scratch).tolist()) for t, _ in texts]
    ones, zeros = (Counter(b for s, (_, y) in zip(sets, texts, strict=True) if y == label for b in s) for label in (1, 0))
    share = (20 + 1) / (60 + 2)
    want = np.zeros(toxicity.BUCKETS)
    for b in ones | zeros:
        n = ones[b] + zeros[b]
        want[b] = np.log((ones[b] + 1) / (n * share + 1)) - np.log((zeros[b] + 1) / (n * (1 - share) + 1))
    pairs = spark.createDataFrame([(y, sorted(s)) for s, (_, y) in zip(sets, texts, strict=True)], "label int, features array<int>")
    table, base = toxicity.ratios(pairs, 1.0)
    assert np.allclose(table, want) and base == pytest.approx(share)
    labelled = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "doc_id long, text string, label int")
    weights, intercept = toxicity.fit(labelled)
    assert not weights[(np.abs(want) < 0.5)].any()
    for row in toxicity.score(labelled, weights, intercept).collect():
        total = intercept + weights[sorted(sets[row.doc_id])].astype(np.float32).sum(dtype=float)
        assert row.score == pytest.approx(1 / (1 + np.exp(-total)), rel=1e-6)


def test_labels_are_drawn_before_texts(spark):
    """The draw takes rows by key and label alone, about as many as asked for, the same ones each time."""
    labels = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 10 = 0, NULL, id % 3) AS label")
    drawn = toxicity.draw(labels, train_rows=2000)
    assert 1800 < drawn.count() < 2200
    assert drawn.where("label IS NULL OR label = 2").isEmpty()
    ids = {r.doc_id for r in drawn.collect()}
    assert ids == {r.doc_id for r in toxicity.draw(labels.repartition(5), train_rows=2000).collect()}
    assert toxicity.draw(labels).count() == labels.where("label IN (0, 1)").count()


def test_toxicity_learns_words_and_survives_edges(spark, make, edges):
    texts = [(i, prose(i, 40) + (" zounds" if i % 4 == 0 else "")) for i in range(200)]
    labelled = spark.createDataFrame([(i, t, int(i % 4 == 0)) for i, t in texts] + [(900, None, None), (901, None, 0), (902, "x", 5)], "doc_id long, text string, label int")
    weights, intercept = toxicity.fit(labelled)
    new = make([(1, prose(701, 40) + " zounds"), (2, prose(702, 40))])
    scores = {r.doc_id: r.score for r in toxicity.score(new, weights, intercept).collect()}
    assert scores[1] > 0.5 > scores[2]
    assert toxicity.score(make(edges), weights, intercept).where("score BETWEEN 0 AND 1").count() == len(edges)
    weights, intercept = toxicity.fit(labelled.where("label = 0"))
    assert not weights.any()
    weights, intercept = toxicity.fit(labelled.limit(0))
    assert not weights.any() and intercept == 0


@pytest.mark.parametrize("text", ["\n" * 20_000, "\n" * 20_000 + "end", "é\n" * 9_000, "start " + "\x00" * 20_000 + " end"])
def test_characters_without_pieces_come_in_bounded_runs(model, library, text):
    marked = "▁" + text.replace(" ", "▁")
    runs = list(pieces.stream(model, marked))
    most = 4 * 2 * (model.longest + 1)  # four bytes a character
    assert len(runs) > 50 and max(map(len, runs)) <= most
    assert [i for run in runs for i in run] == library.encode(text) == pieces.encode_text(model, text)


@pytest.mark.parametrize(
    "text", ["", " ", "  ", "a", " a", "a ", "a  b", "  a   b  ", "▁a b▁▁c", "a\nb \n c", "x" * 500, "  " * 300 + "y" * 300 + " z" * 300]
)
@pytest.mark.parametrize("stretch", [1, 2, 7, 1 << 16])
def test_stretches_do_not_change_ids(model, library, monkeypatch, text, stretch):
    monkeypatch.setattr(pieces, "STRETCH", stretch)
    assert pieces.encode_text(model, text) == library.encode(text)
    if text:
        parts = list(pieces.stretches(" " + text, stretch))
        assert "".join(parts) == " " + text and all(p.startswith(" ") for p in parts)


def test_odd_ids_have_a_text(model):
    good = pieces.encode_text(model, "plain")
    assert pieces.decode_ids(model, good) == "plain"
    for odd in (None, -1, len(model.pieces), 2**31 - 1):
        assert pieces.decode_ids(model, [*good, odd]) == "plain ⁇ "
    assert pieces.decode_ids(model, None) == pieces.decode_ids(model, []) == ""
    assert pieces.decode_ids(model, [model.byte_ids[0xFF]]) == "�"


def test_words_that_are_not_used_go(model, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 10)
    words = pieces.Words(lambda word: word.encode())
    for n in range(100):
        assert words[f"w{n}"] == f"w{n}".encode() and words["often"] == b"often"
    assert len(words) <= 10 and len(words.older) <= 10
