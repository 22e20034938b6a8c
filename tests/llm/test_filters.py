"""Classifiers, line rules, secrets and URL lists against plain versions."""

import datetime as dt
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from helpers import PROSE, documents, odd_rows, words
from pyspark.sql import functions as F

from tessera.llm import line_rules, quality, queries, secrets, toxicity, url_lists
from tessera.llm.common import fold

SF = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_fold_matches_crc32(spark):
    rows = spark.createDataFrame([(i,) for i in [0, 1, 5, -3, 10**12, None]], "doc_id long").select("doc_id", fold().alias("f")).collect()
    assert all(r["f"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 if r["doc_id"] is not None else 0) for r in rows)


# quality


def test_statistics_of_odd_texts_are_finite():
    for _, t in odd_rows():
        x = quality.statistics(t or "")
        assert len(x) == len(quality.STATISTICS) and np.isfinite(x).all()


def test_discriminant_matches_dense_algebra(spark):
    rng = np.random.default_rng(1)
    k = len(quality.STATISTICS)
    x = np.concatenate([rng.normal(0, 1, (60, k)), rng.normal(0.8, 2, (40, k))])
    y = [0] * 60 + [1] * 40
    rows = spark.createDataFrame([(v.tolist(), c) for v, c in zip(x, y)], "stats array<double>, label long").repartition(3)
    model = quality.fit(rows, 0.2, 0.05)
    within = [np.cov(x[np.array(y) == c].T, bias=True) for c in (0, 1)]
    pooled = 0.6 * within[0] + 0.4 * within[1]
    dens = []
    for c, n in ((0, 60), (1, 40)):
        cov = 0.8 * within[c] + 0.2 * pooled
        cov = 0.95 * cov + 0.05 * np.diag(np.diag(cov)) + 1e-6 * np.eye(k)
        d = x - x[np.array(y) == c].mean(axis=0)
        dens.append(np.log(n / 100) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.log_odds(x), dens[1] - dens[0])


def test_quality_held_out_accuracy(spark):
    out = queries.QUERIES["op6_quality"](spark, SF)
    rows = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.95


def test_quality_odd_rows_and_missing_labels(spark):
    docs = documents(spark, odd_rows())
    labels = labels_of(spark, [(1, 1, 0), (7, 0, 1), (8, 1, 0), (13, 0, 0), (13, 1, 0), (None, 1, 1), (5, None, None), (99, 1, 1)])
    out = quality.quality_scores(docs, labels, F.lit(True)).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (4, 5)}) == 1  # null and empty
    none = quality.quality_scores(docs, labels.limit(0), F.lit(True)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality_scores(documents(spark, []), labels, F.lit(True)).count() == 0
    model = quality.learnt(docs, labels, F.lit(True))
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    want = sorted(r["doc_id"] or 0 for r in out if r["score"] >= 0.7)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == want


# toxicity


def test_ordinal_gradient_finds_ordered_grades():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        toxic = int(i % 4 == 0)
        terms = {int(t): int(c) for t, c in zip(rng.integers(50, 400, 30), rng.integers(1, 3, 30))}
        if toxic:
            for t in rng.integers(0, 10, rng.integers(1, 9)):
                terms[int(t)] = terms.get(int(t), 0) + 1
        rows.append((toxic, np.array(sorted(terms)), np.array([terms[t] for t in sorted(terms)])))
    model = toxicity.fit(rows)
    assert (np.diff(model.thresholds) > 0).all()
    weights = np.zeros(toxicity.SPACE)
    weights[model.terms] = model.weights
    value = np.array([(weights[t] * (1 + np.log(c))).sum() for _, t, c in rows])
    above = model.above(value)
    assert (np.diff(above, axis=1) <= 0).all()
    assert ((above[:, 0] >= 0.5) == np.array([r[0] for r in rows])).mean() > 0.99
    many = np.array([len(t[t < 10]) for _, t, _ in rows])
    toxic = many > 0
    assert np.corrcoef(above.sum(axis=1)[toxic], many[toxic])[0, 1] > 0.7
    assert toxicity.fit([]) is None and toxicity.fit([(1, np.array([1]), np.array([1]))]) is None


def test_the_number_of_terms_is_a_parameter():
    rng = np.random.default_rng(3)
    rows = [(i % 2, np.unique(rng.integers(0, 300, 20)), None) for i in range(200)]
    rows = [(y, t, np.ones(len(t), np.int64)) for y, t, _ in rows] + [(1, np.array([900]), np.array([3]))]
    twice = np.flatnonzero(np.bincount(np.concatenate([t for _, t, _ in rows])) > 1)
    assert (toxicity.fit(rows, rounds=5, max_terms=None).terms == twice).all()
    assert len(toxicity.fit(rows, rounds=5, max_terms=7).terms) == 7


def test_toxicity_held_out(spark):
    out = queries.QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1")
    rows = out.withColumnRenamed("toxic", "found").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    caught = [r["found"] for r in held if r["toxic"] == 1]
    clean = [r["found"] for r in held if r["toxic"] == 0]
    assert np.mean(caught) >= 0.85 and np.mean(clean) <= 0.01


def test_toxicity_odd_rows(spark):
    docs = documents(spark, odd_rows() + [(20, "vile scum"), (21, "vile dirt")])
    labels = labels_of(spark, [(1, 1, 0), (8, 1, 0), (7, 1, 0), (20, 1, 1), (21, 1, 1), (None, 0, 1)])
    model = toxicity.learn(docs, labels, F.lit(True))
    out = toxicity.severity(docs, model).collect()
    assert len(out) == len(odd_rows()) + 2
    assert all(0 <= r["score"] <= 1 and 0 <= r["expected_severity"] <= 3 and 0 <= r["grade"] <= 3 for r in out)
    by = {r["doc_id"]: r["score"] for r in out}
    assert by[20] > by[1]
    assert {r["score"] for r in toxicity.severity(docs, None).collect()} == {0.0}
    assert toxicity.severity(documents(spark, []), model).count() == 0
    assert toxicity.learn(docs, labels.limit(0), F.lit(True)) is None


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (line_rules, "quality")])
def test_a_repeated_id_is_learnt_from_once(spark, monkeypatch, module, label):
    seen = []
    monkeypatch.setattr(module, "fit", lambda rows, **_: seen.append(rows))
    docs = documents(spark, [(1, f"{PROSE} {i}") for i in range(50)] + [(2, "vile scum"), (3, None), (3, "vile dirt"), (4, "one more")]).repartition(5)
    labels = labels_of(spark, [(1, 0, 0), (2, 1, 1), (3, 1, 1), (4, 0, 0)])
    module.learn(docs, labels, F.lit(True), max_rows=4)
    assert sorted(r[0] for r in seen[0]) == [0, 0, 1, 1]
    both = [module.learn(docs.repartition(n), labels, F.lit(True), label=label) for n in (1, 7)]
    assert both == [None, None] and len(seen) == 3
    key = lambda rows: sorted((r[0], *(x.tobytes() for x in r[1:])) for r in rows)
    assert key(seen[0]) == key(seen[1]) == key(seen[2])


# line rules


def base(text):
    text = text or ""
    w = words(text)
    at = {}
    for j in range(len(w) - 7):
        at.setdefault(tuple(w[j : j + 8]), []).append(j)
    cover = {j + d for v in at.values() if len(v) > 1 for j in v for d in range(8)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover), len(w) < 20 or 100 * len(cover) > 30 * len(w)


def check_base(rows, out):
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]))
        assert not (r["base_failed"] and r["kept"])
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(base(t))
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(v) for k, v in want.items()}


def test_base_rules(spark):
    r = random.Random(4)
    rows = odd_rows() + [(100 + i, "".join(r.choice(["a ", "b ", "a b a b a b a b ", "\n", "#", "|x ", "\t", "é "]) for _ in range(r.randint(0, 60)))) for i in range(80)]
    check_base(rows, line_rules.line_rules(documents(spark, rows), None).collect())
    assert line_rules.line_rules(documents(spark, []), None).count() == 0


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5):
        field = line_rules.Field(rng.normal(size=(2, line_rules.FEATURES)), rng.normal(size=(2, 2)))
        x = rng.normal(size=(n, line_rules.FEATURES))
        s = x @ field.emit.T
        value = lambda y: sum(s[t, y[t]] for t in range(n)) + sum(field.move[a, b] for a, b in zip(y, y[1:]))  # noqa: E731, B023
        assert tuple(field.viterbi(x)) == max(itertools.product((0, 1), repeat=n), key=value)


def test_line_field_learns_by_likelihood():
    rng = np.random.default_rng(6)
    chains = [(y, rng.normal(1.5 * y, 1, (rng.integers(1, 9), line_rules.FEATURES))) for y in (0, 1) for _ in range(40)]
    field = line_rules.likeliest([x for _, x in chains], [np.full(len(x), y) for y, x in chains], np.full(len(chains), 0.5 / 180))
    right = [np.mean(field.viterbi(x) == y) for y, x in chains]
    assert np.mean(right) > 0.95 and field.move[0, 0] + field.move[1, 1] > field.move[0, 1] + field.move[1, 0]
    assert line_rules.fit(chains[:40]) is None


def test_mixed_texts_have_mixed_lines():
    """Texts learnt by their label alone: prose between a head and a foot of boilerplate is told line by line."""
    r = random.Random(13)
    vocabulary = PROSE.split()
    prose = lambda: " ".join(r.choice(vocabulary) for _ in range(r.randint(8, 20))).capitalize() + "."
    junk = lambda: r.choice([" | ".join(r.choice(vocabulary) for _ in range(5)), "### $$$ " + r.choice(vocabulary).upper() + " %%%", " ".join(r.choice(vocabulary).upper() + "!!" for _ in range(5))])

    def text(mixed, good):
        head, body, foot = [r.randint(2, 6) for _ in range(3)]
        kinds = [0] * head + [1] * body + [0] * foot if mixed else [good] * (head + body)
        return kinds, [(prose() if k else junk()).encode() for k in kinds]

    features = lambda lines: line_rules.line_features(lines, [x.split() for x in lines])
    learnt = [(good, text(i % 5 == 0, good)[1]) for i in range(400) for good in (i % 2,)]
    field = line_rules.fit([(good, features(lines)) for good, lines in learnt])
    right = [np.mean(field.viterbi(features(lines)) == kinds) for kinds, lines in (text(True, 0) for _ in range(100))]
    assert np.mean(right) >= 0.9


def test_likeliest_field_has_no_slope():
    """The gradient of the likelihood, by differences of the plain sum over all labellings."""
    rng = np.random.default_rng(14)
    chains = [rng.normal(size=(n, line_rules.FEATURES)) for n in (1, 2, 4, 3)]
    labels = [rng.integers(0, 2, len(c)) for c in chains]
    weight = rng.uniform(0.1, 0.3, len(chains))

    def loss(p, ridge=0.05):
        field = line_rules.Field(p[: 2 * line_rules.FEATURES].reshape(2, -1), p[2 * line_rules.FEATURES :].reshape(2, 2))
        out = ridge / 2 * (p @ p)
        for x, y, w in zip(chains, labels, weight):
            s = x @ field.emit.T
            value = lambda y: sum(s[t, y[t]] for t in range(len(x))) + sum(field.move[a, b] for a, b in zip(y, y[1:]))  # noqa: E731, B023
            out += w * (np.logaddexp.reduce([value(z) for z in itertools.product((0, 1), repeat=len(x))]) - value(y))
        return out

    field = line_rules.likeliest(chains, labels, weight, rounds=3000, ridge=0.05)
    p = np.concatenate([field.emit.ravel(), field.move.ravel()])
    slope = [(loss(p + h) - loss(p - h)) / 2e-5 for h in np.eye(len(p)) * 1e-5]
    assert np.abs(slope).max() < 1e-3


def test_failed_texts_have_their_own_share(spark):
    emit = np.zeros((2, line_rules.FEATURES))
    emit[1, 0], emit[0, 2] = 1, 5  # lines of three words or fewer are boilerplate
    rows = [(1, "one two\nthree four five six\nseven"), (2, "one two"), (3, PROSE), (4, (PROSE + "\n") * 3 + "a b c"), (5, None)]
    out = {r["doc_id"]: r for r in line_rules.line_rules(documents(spark, rows), line_rules.Field(emit, np.zeros((2, 2)))).collect()}
    n = len(words(PROSE))
    want = {1: 4 / 7, 2: 0.0, 3: 1.0, 4: 3 * n / (3 * n + 3), 5: 0.0}
    assert {i: r["content_share"] for i, r in out.items()} == pytest.approx(want)
    assert {i for i, r in out.items() if r["base_failed"]} == {1, 2, 4, 5} and {i for i, r in out.items() if r["kept"]} == {3}


def test_line_rules_query(spark):
    rows = queries.QUERIES["op7_line_rules"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    check_base([(r["doc_id"], texts[r["doc_id"]]) for r in rows], rows)
    held = [r for r in rows if held_out(r["doc_id"]) and not r["base_failed"]]
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in held]) >= 0.95


# secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def secret_rows():
    r = random.Random(7)
    bits = ["password=", "TOKEN : ", 'api_key="', "secret", "apikey='", "x", " ", "é🙂", "AKIA", "ABCDEF0123456789", "deadbeef" * 4, "0123456789abcdef" * 2, "=", ":", "abc", "abcdefgh", "\n", "ſecret=abcdefghij", "toKen=abcdefghi"]
    rows = odd_rows() + [(100 + i, "".join(r.choice(bits) for _ in range(r.randint(1, 25)))) for i in range(150)]
    rows += [
        (300, "key " + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(48)) + " end"),
        (301, "run " + "abcabc123123" * 6 + " end"), (302, "no " + "1" * 40 + " end"), (303, "up " + "AB12" * 12 + " end"),
        (304, "secret = token : abcdefghijk"), (305, "password=short token=abcdefghij"),
    ]
    return rows


def test_base_spans_of_secrets(spark):
    rows = secret_rows()
    out = secrets.with_spans(documents(spark, rows).withColumn("at", F.monotonically_increasing_id())).collect()
    assert len(out) == len(rows)
    for r in out:
        got = [(s["start"], s["kind"], s["end"]) for s in r["spans"]]
        assert [g for g in got if g[1] < 3] == base_spans(r["text"]), r["text"]
        assert got == sorted(got)


def test_random_runs_and_the_plain_battery(spark):
    rows = secret_rows()
    out = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 3] for r in secrets.with_spans(documents(spark, rows), level=0.05).collect()}
    assert out[300] == [(4, 52)] and not out[301] and not out[302] and not out[303]


def test_runs_without_digits_are_tested(spark):
    r = random.Random(11)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    keys = ["".join(r.choice(a) for _ in range(n)) for a, n in ((upper + "234567", 16), (upper + upper.lower(), 24), (upper + upper.lower() + "+/", 40)) for _ in range(200)]
    keys = [k for k in keys if not re.search("[0-9]", k)][:300]
    rows = [(i, f"key {k} end") for i, k in enumerate(keys)] + [(1000 + i, "no " + "abcd" * 8 + " end") for i in range(20)] + [(2000, "=" * 40 + " " + "-" * 40)]
    out = {x["doc_id"]: [(s["start"], s["end"]) for s in x["spans"] if s["kind"] == 3] for x in secrets.with_spans(documents(spark, rows)).collect()}
    found = [out[i] == [(4, 4 + len(k))] for i, k in enumerate(keys)]
    assert np.mean(found) >= 0.9
    assert not any(out[i] for i in out if i >= 1000)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tested = docs.select(F.sum(F.size(secrets.candidates(F.col("text"), secrets.text_table(docs))))).first()[0]
    assert tested == len(keys) + 20 + 1  # padding alone is no run


def plain_battery(run):
    bare = run.replace("=", "")
    letters = next(a for p, a in secrets.ENCODINGS if not p or re.match(p, bare))
    v = [letters.index(c) if c in letters else -1 for c in bare]
    n, size = len(v), len(letters)
    bins = max(2, min(size, n // 5))
    want = [sum(1 for x in range(size) if x * bins // size == b) / size * n for b in range(bins)]
    have = [sum(1 for x in v if x * bins // size == b) for b in range(bins)]
    chi = sum((h - w) ** 2 / w for h, w in zip(have, want))
    from math import erfc, sqrt

    tail = lambda z: max(erfc(abs(z) / sqrt(2)), 1e-300)
    d = bins - 1
    z = ((chi / d) ** (1 / 3) - (1 - 2 / (9 * d))) / sqrt(2 / (9 * d))
    p_chi = tail(z) / 2 if z > 0 else 1 - tail(z) / 2
    up = [x >= size / 2 for x in v]
    u, dn = sum(up), n - sum(up)
    runs = 1 + sum(a != b for a, b in zip(up, up[1:]))
    mu = 2 * u * dn / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    p_runs = 1e-300 if not u or not dn or var <= 0 else tail((runs - mu) / sqrt(var))
    m = sum(v) / n
    ss = sum((x - m) ** 2 for x in v)
    p_serial = 1e-300 if ss <= 1e-9 else tail((sum((a - m) * (b - m) for a, b in zip(v, v[1:])) / ss + 1 / n) * sqrt(n))
    return n, min(1, 3 * min(p_chi, p_runs, p_serial))


def test_battery_matches_the_plain_one(spark):
    r = random.Random(8)
    sets = ["0123456789", "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz0123456789", "".join(chr(c) for c in range(33, 123) if chr(c).isalnum()) + "+/"]
    runs = ["".join(r.choice(s) for _ in range(r.randint(16, 90))) + "1" for s in sets for _ in range(6)] + ["1" * 20, "ab12" * 9, "0123456789" * 3]
    out = spark.createDataFrame([(x,) for x in runs], "run string").select("run", secrets._battery(F.col("run")).alias("t")).collect()
    for row in out:
        n, p = plain_battery(row["run"])
        assert row["t"]["n"] == n and row["t"]["p"] == pytest.approx(p, abs=2e-6), row["run"]


def plain_text_table(texts, min_length=16):
    letters, n = secrets.FOLDED, len(secrets.FOLDED)
    c = np.zeros((n, n))
    for t in texts:
        for w in re.findall("[A-Za-z0-9+/_-]+", t or ""):
            if len(w) < min_length:
                for a, b in zip(w.lower(), w.lower()[1:]):
                    c[letters.index(a), letters.index(b)] += 1
    one = (c.sum(axis=0) + 1) / (c.sum() + n)
    two = (c + n * one) / (c.sum(axis=1, keepdims=True) + n)
    return -np.log2(0.8 * two + 0.15 * one + 0.05 / n), -np.log2(0.95 * one + 0.05 / n)


def plain_text_p(run, tables):
    bare = run.replace("=", "")
    own = next(a for p, a in secrets.ENCODINGS if not p or re.match(p, bare))
    v = [secrets.FOLDED.index(c) for c in bare.lower()]
    text = tables[1][v[0]] + sum(tables[0][a, b] for a, b in zip(v, v[1:]))
    even = sum(np.log2(len(own)) - (x < 26 and "a" in own and "A" in own) for x in v)
    return min(1.0, len(secrets.ENCODINGS) * 2.0 ** (even - text))


def test_text_p_matches_the_plain_one(spark):
    texts = [PROSE, "Déjà vu x-y a/b_c 42", None, "", "A" * 40, "ab" * 7 + " " + "Ab1 " * 50]
    docs = documents(spark, list(enumerate(texts)))
    table, tables = secrets.text_table(docs), plain_text_table(texts)
    assert np.allclose(table, np.concatenate([tables[0].ravel(), tables[1]]))
    runs = ["thequickbrownfoxjumps", "XQZJKVXQZJKVXQZJKV", "aB3+/zZ09_-xyzQW12==", "0123456789" * 2, "deadbeefdeadbeef1"]
    for r in spark.createDataFrame([(x,) for x in runs], "run string").select("run", secrets._text_p(F.col("run"), table).alias("q")).collect():
        assert np.log2(r["q"]) == pytest.approx(np.log2(plain_text_p(r["run"], tables)), abs=0.01)


def test_rejection_step_is_benjamini_hochberg(spark):
    r = random.Random(9)
    syllables = PROSE.split()
    rows = [(i, "".join(r.choice("0123456789abcdefghjkmnpqrstvwxyz") for _ in range(r.randint(16, 31))) if i % 3 else "".join(r.choice(syllables) for _ in range(9))) for i in range(90)]
    rows += [(100 + i, PROSE) for i in range(30)] + [(200, "ab12" * 12)]
    docs = documents(spark, rows)
    scanned = docs.select(secrets.candidates(F.col("text"), secrets.text_table(docs)).alias("runs"))
    step, mean = secrets.rejection_step(scanned)
    tables = plain_text_table([t for _, t in rows])
    runs = [(n, 1.0 if p < 0.001 else plain_text_p(t, tables)) for i, t in rows if " " not in t for n, p in [plain_battery(t)]]
    m, w = len(runs), np.mean([n**0.5 for n, _ in runs])
    assert mean == pytest.approx(w)
    at = lambda p: min(secrets.STEPS * secrets.POWERS, max(0, int(np.floor(-np.log10(max(p, 1e-300)) * secrets.STEPS))))
    steps = [at(10 ** (-at(p) / secrets.STEPS) * w / n**0.5) for n, p in runs]
    want = min(s for s in steps if 10 ** (-s / secrets.STEPS) * m <= 0.05 * sum(x >= s for x in steps))
    assert abs(step - want) <= 1


def test_planted_keys_are_found_and_words_are_not(spark):
    """Keys of 20 to 40 characters of each alphabet among the words of the corpus."""
    r = random.Random(12)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alphabets = (upper, upper.lower(), upper + upper.lower(), upper + "234567", upper + upper.lower() + "0123456789", upper + upper.lower() + "0123456789+/")
    keys = [(a, "".join(r.choice(a) for _ in range(r.randint(20, 40)))) for a in alphabets for _ in range(60)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    planted = spark.createDataFrame([(-1 - i, f"the key {k} of the house") for i, (_, k) in enumerate(keys)], "doc_id long, text string")
    out = secrets.with_spans(docs.unionByName(planted)).select("doc_id", "text", F.filter("spans", lambda s: s["kind"] == 3).alias("found")).collect()
    got = {x["doc_id"]: [(s["start"], s["end"]) for s in x["found"]] for x in out}
    for a in alphabets:
        own = [got[-1 - i] == [(8, 8 + len(k))] for i, (b, k) in enumerate(keys) if a == b]
        assert np.mean(own) >= 0.9
    others = [x["text"][s["start"] : s["end"]] for x in out if x["doc_id"] >= 0 for s in x["found"]]
    assert len(others) <= 3, others


def test_many_matches_in_one_text(spark):
    text = " ".join(f"{i:032x} password=abcdefgh{i}" for i in range(2_000))
    (r,) = secrets.with_spans(documents(spark, [(1, text)])).collect()
    assert [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] < 3] == base_spans(text)


def test_redaction(spark):
    rows = [(1, "a password=abcdefgh12 z"), (2, 'token="' + "deadbeef" * 5 + '" é'), (3, None), (4, "clean text"), (5, "AKIA" + "A" * 14), (6, "x" * 3 + " AKIA" + "B" * 14 + " password=abcdefghi")]
    out = {r["doc_id"]: r["text"] for r in secrets.redacted(documents(spark, rows)).collect()}
    assert out == {1: "a [SECRET] z", 2: '[SECRET]" é', 3: None, 4: "clean text", 5: "[SECRET]", 6: "xxx [SECRET] [SECRET]"}


def test_secrets_query_and_empty_tables(spark):
    assert secrets.with_spans(documents(spark, [])).count() == 0
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    out = queries.QUERIES["op8_secrets"](spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        own = base_spans(texts[r["doc_id"]])
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in own)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in own) for k in range(3)]


def test_secret_plan_is_native(spark):
    plan = queries.QUERIES["op8_secrets"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# URL lists


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def test_intervals(spark):
    rows = [("host", "a.b", day(1), True), ("host", "a.b", day(5), False), ("host", "a.b", day(3), True), ("host", "a.b", day(9), True), ("host", "a.b", day(9), True),
            ("host", "c.d", day(2), True), ("host", "c.d", day(2), False), ("url", "e.f/", day(0), False), (None, "x", day(1), True), ("url", None, day(1), True), ("url", "x", None, True), ("url", "x", day(1), None)]
    out = {(r["kind"], r["key"]): [(s["since"], s["until"]) for s in r["spells"]] for r in url_lists.intervals(spark.createDataFrame(rows, "kind string, key string, day date, added boolean")).collect()}
    assert out == {("host", "a.b"): [(day(1), day(5)), (day(9), dt.date(9999, 12, 31))]}


def test_evaluated_against_a_plain_version(spark):
    r = random.Random(10)
    hosts = ["a.example.com", "b.a.example.com", "example.org", "x.example.org", "solo"]
    entries = [(r.choice(["host", "domain", "url"]), r.choice(hosts + ["example.com", "com"] + [h + "/p" for h in hosts]), day(r.randrange(40)), r.random() < 0.6) for _ in range(200)]
    pages = [(i, f"{r.choice(['http', 'HTTPS'])}://{r.choice(['', 'u:p@'])}{r.choice(hosts + ['A.Example.COM.', 'a.example.com:80'])}{r.choice(['', '/', '/p', '/p?q=1', '/p#f'])}", day(r.randrange(45))) for i in range(300)]
    pages += [(900, None, day(3)), (901, "no url", day(3)), (902, "http://example.org/p", None), (None, "http://example.org/p", day(20)), (903, "http:///p", day(3)), (5, "http://example.org/p", day(20))]
    schema = "page_id long, url string, fetched_on date, spells string, kind string, row long"
    captures = spark.createDataFrame([(*p, "s", "k", 1) for p in pages], schema)
    lists = url_lists.intervals(spark.createDataFrame(entries, "kind string, key string, day date, added boolean"))
    out = url_lists.evaluated(captures, lists).collect()

    def active(kind, key, when):
        """The state after the last day of entries up to ``when``, and since when."""
        days = {}
        for k, x, d, on in entries:
            if (k, x) == (kind, key):
                days[d] = days.get(d, True) and on
        since = None
        for d in sorted(days):
            if d <= when:
                since = (since or d) if days[d] else None
        return since

    def plain(url, when):
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", url or "")
        host = re.sub(r"\.$", "", re.sub(r"^.*@|:[0-9]*$", "", m[1]).lower()) if m else ""
        if not host or when is None:
            return 0, None
        parts = host.split(".")
        keys = [("url", host + (m[2] or "/")), ("host", host)] + [("domain", ".".join(parts[-k:])) for k in range(len(parts), 1, -1)]
        hits = [(k, x, s) for k, x in keys if (s := active(k, x, when))]
        return len(hits), hits[0] if hits else None

    want = sorted((i or -1, str(w), *((n, h) if h else (n, None))) for i, u, w in pages for n, h in [plain(u, w)])
    got = sorted((r["page_id"] or -1, str(r["fetched_on"]), r["n_active"], (r["matched_kind"], r["matched_key"], r["active_since"]) if r["blocked"] else None) for r in out)
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert url_lists.evaluated(captures.limit(0), lists).count() == 0
    assert not url_lists.evaluated(captures, lists.limit(0)).where("blocked").count()


def test_odd_rows_have_prose():
    assert len(words(PROSE)) > 20


def test_the_domain_above_every_host_is_listed(spark):
    rows = [(1, "http://a.example.com/x", "a.example.com"), (2, "http://b.c.example.com/", "b.c.example.com"), (3, "http://example.org/", "example.org"), (4, "none", "")]
    entries = queries.list_entries(spark.createDataFrame(rows, "page_id long, url string, host string"))
    assert {r["key"] for r in entries.where("kind = 'domain'").collect()} == {"example.com", "c.example.com"}


def test_captures_without_a_host_get_a_row_each(spark):
    rows = [(i, u, "2024-05-05") for i, u in enumerate([None, "", "x", "http:///p", "http://a.b.c/"])]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_on string")
    entries = [("domain", "b.c", "2024-01-01", True), ("url", "0", "2024-01-01", True)]
    lists = url_lists.intervals(spark.createDataFrame(entries, "kind string, key string, day string, added boolean").withColumn("day", F.to_date("day")))
    got = {r["page_id"]: r["n_active"] for r in url_lists.evaluated(captures, lists).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1}
