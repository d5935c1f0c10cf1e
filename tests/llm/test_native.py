"""Operators 1, 2 and 3: plain Python on small tables, odd rows, split and overflow."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.docs import corpus, frame, odd_frame
from usagelens.llm import licenses, mixing, sharding

PY_NODES = ("Python", "Pandas", "Arrow", "ExistingRDD")


def native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(x in plan for x in PY_NODES)


# --- licences ---------------------------------------------------------------------------------------

def brute_base(t):
    w = licenses.template_words(t or "")
    places = [(k, label) for label, phrase in licenses.PHRASES for p in [phrase.split()]
              for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
    at = [k for k, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def licence_texts():
    rng = random.Random(31)
    out = ["MIT License", "the MIT-license, mit  LICENSE mit license", "General Public\nLicense general public", "license mit", None, "",
           " .,- ", "É MIT İ license", "Apache\x00License" , "mit license " * 500]
    for _, n in licenses.NOTICES:
        w = n.split()
        out += ["start here " + n + " end", " ".join(w[:len(w) // 3])]
        w.insert(len(w) // 2, "inserted")
        out.append("x " * rng.randrange(20) + " ".join(w))
    return out + corpus(31, 10)


def test_licence_base_counts_and_labels(spark):
    texts = licence_texts()
    ids = [None if k % 9 == 0 else k // 2 for k in range(len(texts))]
    got = licenses.scan(odd_frame(spark, texts, ids))
    want = sorted(((i, *brute_base(t)) for i, t in zip(ids, texts)), key=str)
    rows = got.collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=str) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in rows)
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in rows)


def test_licence_notices_found_whole_and_edited(spark):
    texts = [f"before {n} after" for _, n in licenses.NOTICES]
    edited = []
    for _, n in licenses.NOTICES:
        w = n.split()
        edited.append(" ".join(w[:len(w) // 2] + ["really"] + w[len(w) // 2:]))
    rows = {r.doc_id: r for r in licenses.scan(frame(spark, texts + edited)).collect()}
    for k, (label, n) in enumerate(licenses.NOTICES):
        assert label in rows[k].labels.split(",") and rows[k].score == 1.0
        if len(n.split()) > 10:
            assert label in rows[len(texts) + k].labels.split(",")


def test_licence_scattered_words_are_no_notice(spark):
    w = licenses.NOTICES[0][1].split()
    text = " filler words go in here ".join(" ".join(w[k:k + 3]) for k in range(0, len(w), 3))
    assert licenses.scan(frame(spark, [text])).first().labels == ""


def test_licence_notices_repeated_in_a_row(spark):
    """Back-to-back copies, whole and with a word put in, are found however many there are."""
    cases = [(label, n, k, edit) for label, n in licenses.NOTICES for k in (1, 2, 3, 500) for edit in (False, True)]
    texts = []
    for _, n, k, edit in cases:
        w = n.split()
        texts.append(" ".join(["before", *((w[:len(w) // 2] + ["really"] * edit + w[len(w) // 2:]) * k), "after"]))
    rows = {r.doc_id: r for r in licenses.scan(frame(spark, texts)).collect()}
    once = {}
    for i, (label, n, k, edit) in enumerate(cases):
        got = rows[i].labels.split(","), rows[i].score
        if k == 1:
            once[n, edit] = got
        if not edit:
            assert label in got[0] and got[1] == 1.0, (n, k)
        assert set(once[n, edit][0]) <= set(got[0]) and got[1] >= once[n, edit][1], (n, k, edit)
    scattered = " ".join(f"{a} {b} {c} x y z" for _, n in licenses.NOTICES[:1] for w in [n.split()] for a, b, c in zip(w, w[1:], w[2:]))
    place = licenses.spans(frame(spark, ["one " * 50 + (licenses.NOTICES[10][1] + "\n") * 9, scattered])).collect()
    assert [(r.doc_id, r.label, r.first_word >= 50, r.last_word - r.first_word + 1 <= 12) for r in place] == [(0, "cc-by", True, True)]


# --- mixing -----------------------------------------------------------------------------------------

def water(total, caps, weights):
    """Plain water filling: serve in rounds, redistribute what full children leave."""
    share, open_, left = dict.fromkeys(caps, 0.0), {k for k in caps if weights[k] > 0}, total
    while open_ and left > 1e-9:
        w = sum(weights[k] for k in open_)
        full = {k for k in open_ if share[k] + left * weights[k] / w >= caps[k] - 1e-9}
        if not full:
            for k in open_:
                share[k] += left * weights[k] / w
            break
        add = {k: caps[k] - share[k] for k in full}
        for k in full:
            share[k] = caps[k]
        left -= sum(add.values())
        open_ -= full
    return share


def leaves_of(rows):
    out = defaultdict(int)
    for d, la, s, n in rows:
        out[d, la, s] += n
    return out


def test_budgets_fill_siblings_before_ancestors(spark):
    leaf = {("web", "en", "a"): 100, ("web", "en", "b"): 10, ("web", "de", "a"): 7, ("books", "en", "c"): 1000, ("code", "en", "x"): 5}
    weights = {"domain": {"web": 3, "books": 1, "code": 2}, "lang": {"de": 5}, "source": {"b": 4}}
    df = spark.createDataFrame([(*k, v, 1, v) for k, v in leaf.items()], "domain string, lang string, source string, tokens long, n_rows long, cap long")
    for total in (0, 1, 50, 120, 130, 500, 5000):
        got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(df, total, weights).collect()}
        assert sum(got.values()) == min(total, sum(leaf.values()))
        cap = lambda *p: sum(v for k, v in leaf.items() if k[:len(p)] == p)
        w = lambda level, k: weights[level].get(k, 1)
        dom = water(min(total, cap()), {d: cap(d) for d in ("web", "books", "code")}, {d: w("domain", d) for d in ("web", "books", "code")})
        for d in dom:
            assert abs(sum(v for k, v in got.items() if k[0] == d) - dom[d]) <= 3
        web = water(dom["web"], {"en": cap("web", "en"), "de": cap("web", "de")}, {"en": 1, "de": 5})
        assert abs(got["web", "de", "a"] - web["de"]) <= 3
        assert all(got[k] <= leaf[k] for k in leaf)


def test_mix_draws_whole_epochs_and_a_prefix(spark):
    rng = random.Random(32)
    texts = ["word " * rng.randrange(0, 30) for _ in range(300)] + [None, ""]
    df = odd_frame(spark, texts)
    out = mixing.mix(df, budget_share=0.9).collect()
    n = {k: len((t or "").split()) for k, t in enumerate(texts)}
    rows = [(r.domain, r.lang, r.source, r.n_tokens, r.doc_id) for r in mixing.leaf_rows(df).collect()]
    leaf = leaves_of(r[:4] for r in rows)
    plan = {(r.domain, r.lang, r.source): r for r in mixing.plan(mixing.leaf_rows(df), budget_share=0.9).collect()}
    used, per = defaultdict(int), defaultdict(Counter)
    for r in out:
        assert r.n_tokens == n[r.doc_id]
        used[r.domain, r.lang, r.source] += r.n_tokens
        per[r.domain, r.lang, r.source][r.doc_id] += 1
    for key, p in plan.items():
        own = {d: t for *k, t, d in rows if tuple(k) == key}
        assert used[key] <= p.budget and p.tokens == leaf[key]
        times = {per[key][d] for d in own}
        assert times <= {p.epochs, p.epochs + 1}
        if p.tokens:        # one more document would not have fitted
            missing = [t for d, t in own.items() if per[key][d] == p.epochs]
            assert not missing or p.budget - used[key] < max(missing)
    again = mixing.mix(df.repartition(5), budget_share=0.9).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    copied = mixing.mixed_documents(df, budget_share=0.9)
    assert copied.columns == df.columns
    assert Counter(r.doc_id for r in copied.collect()) == Counter(r.doc_id for r in out)


def test_mix_nulls_ties_and_empty(spark):
    texts = ["a b c"] * 6 + ["d e"] * 3
    df = frame(spark, texts, [None, None, None, 1, 1, 2, 3, 4, 5]).withColumn("lang", F.lit(None).cast("string")) \
        .withColumn("source", F.lit(None).cast("string"))
    out = mixing.mix(df, budget_share=0.5).collect()
    assert {(r.domain, r.lang, r.source) for r in out} == {("reference", "(none)", "(none)")}
    assert sum(r.n_tokens for r in out) <= 12
    assert mixing.mix(frame(spark, [])).collect() == []
    assert mixing.mixed_documents(frame(spark, [])).collect() == []


# --- sharding ---------------------------------------------------------------------------------------

def test_shards_split_only_where_needed(spark):
    texts = corpus(33, 60) + ["z" * 5000]
    df = odd_frame(spark, texts)
    limit = 3000
    rows = sharding.shards(df, limit).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    load, members = Counter(), defaultdict(list)
    for r in rows:
        assert r.n_bytes == len((texts[r.doc_id] or "").encode())
        load[r.shard] += r.n_bytes
        members[r.shard].append(r)
    assert all(v <= limit or len(members[s]) == 1 for s, v in load.items())
    names = list(load)
    assert not [(a, b) for a in names for b in names if a != b and b.startswith(a)]
    h = {r.doc_id: r.h for r in sharding.index_rows(df).collect()}
    for s in names:         # the bucket one bit up would have been too large
        up = [k for k in h if f"{h[k]:060b}".startswith(s[:-1])]
        assert sum(len((texts[k] or "").encode()) for k in up) > limit


def test_copies_overflow_into_pages(spark):
    df = frame(spark, ["same text here"] * 50 + ["other"], [7] * 50 + [8])
    rows = sharding.shards(df, 100).collect()
    load = Counter()
    for r in rows:
        load[r.shard, r.page] += r.n_bytes
    assert len(rows) == 51 and max(load.values()) <= 100
    docs = sharding.sharded_documents(df, 100).collect()
    load = Counter()
    for r in docs:
        load[r.placed.shard, r.placed.page] += r.placed.n_bytes
    assert max(load.values()) <= 100
    assert Counter((r.doc_id, r.text, r.lang, r.source) for r in docs) == Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def test_shard_nulls_clashes_and_empty(spark):
    df = frame(spark, [None, "", "a"], [None, None, 1]).withColumn("placed", F.lit(1)).withColumn("depth", F.lit(2))
    out = sharding.sharded_documents(df)
    assert out.columns == [*df.columns, "placed_"]
    assert {r.placed_.shard for r in out.collect()} == {"all"}
    assert sharding.shards(frame(spark, [])).collect() == []


def test_no_python_in_native_plans(spark, tmp_path):
    path = str(tmp_path / "docs")
    frame(spark, corpus(34, 10)).write.parquet(path)
    df = spark.read.parquet(path)
    assert native(licenses.scan(df)) and native(mixing.mix(df)) and native(sharding.shards(df))


def test_licence_sql_agrees_on_repeated_notices(spark, tmp_path):
    """One, two, three and many copies of every notice in a row, with gaps and cut, in Spark and in DuckDB."""
    import duckdb

    from usagelens.llm import queries
    texts = []
    for _, text in licenses.NOTICES:
        w = text.split()
        texts += [" ".join([text] * k) for k in (1, 2, 3, 40)] + [" and more words of prose here ".join([text] * 3)]
        texts += [" ".join([" ".join(w[:len(w) * 2 // 3])] * 5), " ".join(w[len(w) // 2:] + w + w[:len(w) // 2])]
    frame(spark, texts).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    res = con.execute(queries.ORACLES["op1_license_scan"])
    names = [d[0] for d in res.description]
    want = sorted(res.fetchall())
    got = sorted(tuple(round(r[c], 12) if isinstance(r[c], float) else r[c] for c in names) for r in queries.QUERIES["op1_license_scan"](spark, str(tmp_path)).collect())
    assert got == [tuple(round(x, 12) if isinstance(x, float) else x for x in r) for r in want]
    assert sum(1 for r in got if r[names.index("labels")]) > 0.7 * len(got)
