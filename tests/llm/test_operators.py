"""Operators against brute-force versions on small tables with awkward rows."""

import hashlib
import math
import re
import textwrap
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoscribe.llm import (chunks, common, jaccard, langid, licenses, mixing, quality, secrets, sharding, templates, url_ratio)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    """Real rows with nulls, empty and long texts, repeats, and extra columns named like internal ones."""
    base = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    extra = [(9001, None, "en", "src0", 0), (9002, "", None, None, 0), (9003, base[0][1], None, "x", 1),
             (9004, " ".join(f"w{i}" for i in range(30_000)), "en", "src1", 1), (None, "one two", "en", None, 7), base[1],
             base[1], (9005, "a b c", "en", "src1", 5), (9006, "A  b\tC", "en", "src1", 5)]
    df = spark.createDataFrame(base + extra, SCHEMA)
    return df.withColumn("id", F.lit("x")).withColumn("u", F.lit(1)).withColumn("size", F.lit(2)).withColumn("row", F.lit(3))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_quality_base_and_outliers(docs, empty):
    rows = quality.judge_quality(docs).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in rows:
        words, text = WORDS.findall(texts[r.doc_id]), texts[r.doc_id]
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        seen = Counter(windows)
        covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality.judge_quality(empty).count() == 0


def test_mcd_resists_contamination(spark):
    rng = np.random.default_rng(3)
    clean = rng.multivariate_normal([1, -2], [[4, 1.5], [1.5, 1]], 1_400)
    rows = [("g", *map(float, x)) for x in [*clean, *rng.normal([40, 40], 1, (600, 2))]]
    e = quality.mcd_estimates(spark.createDataFrame(rows, "grp string, x0 double, x1 double"), (0.1, 0.1)).collect()[0]
    assert np.allclose(e.mean, [1, -2], atol=0.25)
    assert np.allclose(np.linalg.inv(np.array(e.prec).reshape(2, 2)), [[4, 1.5], [1.5, 1]], rtol=0.25)
    assert abs(quality.chi2_cdf(quality.chi2_quantile(0.975, 7), 7) - 0.975) < 1e-9
    assert abs(quality.chi2_quantile(0.95, 2) + 2 * math.log(0.05)) < 1e-6


def test_url_rules_and_model(spark):
    urls = ["http://A.net/x", "http://a.EXAMPLE.net/en/1", "http://example.net/en", "https://b.example.com/de/2?q=/fr/",
            "http://c.org/fr/9#t", "http://c.org/de/9", "http://anet/x", "nothing", "", None, "http://e.net", "http://c.org/fr/9#t"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_ratio.judge_urls(df).collect()}
    assert [got[i].rule for i in range(len(urls))] == [
        "net/", "example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None, None, None, None, "org/fr/"]
    assert (got[1].host, got[1].path) == ("a.example.net", "/en/1") and (got[9].host, got[9].verdict) == ("", "allow")
    assert url_ratio.judge_urls(df.limit(0)).count() == 0

    train = [("abcab", "allow")] * 3 + [("xbcab", "block")] * 2 + [("abcax", "block")]
    scored = {r.gram: r.d for r in url_ratio.gram_scores(
        spark.createDataFrame(train, "gram string, verdict string"),
        spark.createDataFrame([("abcab",), ("zzzzz",), ("xbcax",)], "gram string")).collect()}

    def log_p(gram, verdict):
        p = 1 / url_ratio.ALPHABET
        for k in range(1, 6):
            g, seen = gram[-k:], Counter(t[-k:] for t, v in train if v == verdict)
            after = Counter({x: c for x, c in seen.items() if x[:-1] == g[:-1]})
            if after:
                p = (after[g] + len(after) * p) / (sum(after.values()) + len(after))
        return math.log(p)

    for g, d in scored.items():
        assert d == pytest.approx(log_p(g, "allow") - log_p(g, "block"), abs=1e-9)


def _components(texts):
    sets, parent = {}, {}
    for i, t in texts:
        w = WORDS.findall((t or "").translate(common.ASCII_LOWER))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sets if i is not None]
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i) if i is not None else None) for i in sets}


def test_jaccard_join_is_exact(spark, docs, empty):
    rng = np.random.default_rng(5)
    base = [f"t{i}" for i in range(60)]
    near = []
    for k in range(90):                                    # one large group, one passage in all of them
        words = list(base)
        for j in rng.integers(0, 60, rng.integers(0, 4)):
            words[j] = f"e{k}_{j}"
        near.append((20_000 + k, " ".join(words), "en", "s", 1))
    near += [(30_000 + k, " ".join(base[:25] + [f"q{k}_{j}" for j in range(40)]), "en", "s", 1) for k in range(70)]
    both = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(near, SCHEMA))
    want = _components([(r.doc_id, r.text) for r in both.collect()])
    got = jaccard.jaccard_components(both).collect()
    assert len(got) == both.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    # With a short first digest most sets share it and take their second one.
    short = jaccard.jaccard_components(both, digest_bits=6).collect()
    assert sorted(map(str, short)) == sorted(map(str, got))
    assert jaccard.jaccard_components(empty).count() == 0


def test_language(spark, docs, empty):
    got = langid.predict_language(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held) > 20
    by_id = {r.doc_id: r for r in got}
    assert (by_id[9001].lang_pred, by_id[9001].score, by_id[9002].lang_pred) == ("und", 0.0, "und")
    assert all(0 <= r.score <= 1 for r in got) and langid.predict_language(empty).count() == 0


def test_language_fit_sample_is_bounded_by_texts_not_ids(spark):
    rows = spark.range(9_000).selectExpr("if(id % 3 = 0, 'xx', 'yy') lang",
                                         "if(id % 3 = 1, 'the same text', if(id % 50 = 2, null, concat('text ', id))) text")
    got = langid.fit_sample(rows, 200).collect()
    assert Counter(r.lang for r in got)["xx"] == 200 and 100 <= Counter(r.lang for r in got)["yy"] <= 200
    assert len({tuple(r) for r in got}) == len(got) and all(r.text for r in got)
    assert sorted(got) == sorted(langid.fit_sample(rows.repartition(7), 200).collect())
    few = langid.fit_sample(rows, 100_000).collect()
    assert {tuple(r) for r in few} == {tuple(r) for r in rows.where("text is not null").collect()} and len(few) == len(set(few))


def test_language_fit_sample_ends_with_its_characters(spark):
    rows = spark.range(300).selectExpr("if(id % 3 = 0, 'xx', 'yy') lang", "concat(repeat('long text ', 10), id) text")
    few, more = (langid.fit_sample(rows, 1_000, chars).collect() for chars in (1_000, 100_000))
    for lang, n in (("xx", 100), ("yy", 200)):
        sizes = [len(r.text) for r in few if r.lang == lang]
        assert 1_000 <= sum(sizes) < 1_000 + max(sizes) and sum(r.lang == lang for r in more) == n
    assert {tuple(r) for r in few} <= {tuple(r) for r in more}
    assert len(langid.fit_sample(rows, 1_000, 1).collect()) == 2


def test_language_against_brute_force(spark, docs):
    orders = range(6)
    got = langid.predict_language(docs, fit_docs=12).collect()
    train = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    counts = {n: {} for n in orders}
    for r in langid.fit_sample(train.select("lang", "text"), 12).collect():
        for w in re.findall(r"[^\W\d_]+", r.text.lower()):
            grams = [(n, f" {w} "[i:i + n]) for n in range(2, 6) for i in range(len(w) + 3 - n)] + [(1, c) for c in w]
            for n, item in [(0, w), *grams]:
                counts[n].setdefault(r.lang, Counter())[item] += 1
    langs = sorted(counts[0])
    total = {(n, x): sum(counts[n][x].values()) for n in orders for x in langs}
    known = {n: set().union(*counts[n].values()) for n in orders}

    def logs(n, item):
        return [math.log((counts[n][x].get(item, 0) + 0.5) / (total[n, x] + 0.5 * len(known[n]))) for x in langs]

    def word(w):
        if w in known[0]:
            return logs(0, w)
        for n in range(5, 0, -1):
            padded = f" {w} " if n > 1 else w
            found = [g for g in (padded[i:i + n] for i in range(len(padded) - n + 1)) if g in known[n]]
            if found:
                return [sum(v) / len(found) for v in zip(*(logs(n, g) for g in found))]
        return [0.0] * len(langs)

    seen = {}
    want = []
    for r in docs.collect():
        words = re.findall(r"[^\W\d_]+", r.text.lower()) if r.text else []
        sums = [sum(v) for v in zip(*(seen.setdefault(w, None) or seen.__setitem__(w, word(w)) or seen[w] for w in words))]
        best = max(sums, default=0)
        want.append((r.doc_id, langs[sums.index(best)] if words else "und",
                     1 / sum(math.exp(max(x - best, -700)) for x in sums) if words else 0.0))
    key = lambda t: (t[0] is None, t[0] or 0)
    pairs = list(zip(sorted(want, key=key), sorted(((r.doc_id, r.lang_pred, r.score) for r in got), key=key)))
    assert len(got) == len(want) and all(a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-6, abs_tol=1e-9) for a, b in pairs)


def test_templates(spark, docs, empty):
    items = spark.createDataFrame(
        [(1, "Each day Anna buys 12 apples for 3 dollars and gives Anna's brother 5 of the apples she likes."),
         (2, None), (3, "")], "item_id long, text string")
    rows = [(1, "Noise here. Each day Anna buys 12 apples for 3 dollars and gives Anna's brother 5 of the apples she likes. End", "en", "s", 1),
            (2, "Intro. Each day Berta buys 40 apples for 9 dollars and gives Berta's brother 7 of the apples she likes.", "en", "s", 1),
            (3, "Intro. Each day Berta buys 40 apples for 9 dollars and gives Carla's brother 7 of the apples she likes.", "en", "s", 1),
            (4, "Each day someone buys apples and likes it.", "en", "s", 1)]
    got = templates.contaminated(spark.createDataFrame(rows, SCHEMA), items).collect()
    assert {(r.doc_id, r.item_id, r.slots_changed) for r in got} == {(1, 1, False), (2, 1, True)}
    assert templates.contaminated(empty, items).count() == 0 and templates.contaminated(docs, items.limit(0)).count() == 0


def test_templates_find_the_planted_items(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    flat = {r.doc_id: " ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in docs.collect()}
    want = {d for d, t in flat.items() for i in items.collect() if " ".join(re.findall(r"[^\W_]+", i.text.lower())) in t}
    assert {r.doc_id for r in templates.contaminated(docs, items).collect()} == want


def test_chunks_resist_shifts_and_round_trip(spark, empty):
    rng = np.random.default_rng(1)
    passage = " ".join(f"p{x}é" for x in rng.integers(0, 10 ** 6, 60))

    def filler(k):
        return " ".join(f"f{x}" for x in np.random.default_rng(k).integers(0, 10 ** 9, 40 + k))

    rows = [(k, f"{filler(k)} {passage} {filler(k + 50)}", "en", "s", 1) for k in range(1, 6)]
    rows += [(6, filler(99), "en", "s", 1), (7, None, "en", "s", 1), (8, "", "en", "s", 1), rows[0], (None, filler(98), "e", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = chunks.find_repeats(df)
    got = found.collect()
    assert {1, 2, 3, 4, 5} == {r.doc_id for r in got}
    for r in got:
        if r.doc_id > 1:
            part = dict((x[0], x[1]) for x in rows)[r.doc_id][r.start:r.end]
            assert part in f" {passage} " and len(part) > 0.5 * len(passage) and r.first_id == 1
    cleaned = {r.doc_id: r.text for r in chunks.remove_repeats(df, found).collect()}
    assert cleaned[6] == rows[5][1] and cleaned[7] is None and cleaned[8] == "" and len(cleaned[3]) < len(rows[2][1]) - 200
    data = (passage * 40).encode()
    ends = chunks.chunk_ends(data, chunks.gear_table())
    assert b"".join(data[a:b] for a, b in zip([0, *ends], ends)) == data
    assert chunks.find_repeats(empty).count() == 0


def test_secrets(spark, docs, empty):
    key = "Zk8vQx2LmT9rWp4YbN7c"
    text = f'é password = "abcdefghijkl" token: short AKIA{"A1" * 8} {"0a" * 8} auth_key {key} auth_key get_item_value_0000000000000'
    rows = secrets.find_secrets(spark.createDataFrame([(1, text, "en", "s", 1), (2, None, "en", "s", 1), (3, "", "en", "s", 1),
                                                         *((k, f"call get_item_value_0000000000000 {k}", "en", "s", 1) for k in (4, 5))],
                                                        SCHEMA)).collect()
    one = rows[0]
    assert (one.n_assign, one.n_access, one.n_hex) == (1, 1, 1)
    assert f"novel:{text.index(key)}:{text.index(key) + len(key)}" in one.spans and one.n_novel == 1
    assert rows[1].spans == "" and rows[1].base_sha256 == rows[2].base_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert secrets.find_secrets(docs).count() == docs.count() and secrets.find_secrets(empty).count() == 0


def test_identifier_dictionary_against_brute_force(spark):
    texts = [f"alphabetical value_{k % 7} value_{k % 3} ordinary{'xyz'[k % 3]} word_{k}" for k in range(40)] + [None, ""]
    got = secrets.identifier_dictionary(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5), top=3)
    seen = Counter(x for t in texts if t for x in set(t.split()))
    best = sorted((kv for kv in seen.items() if kv[1] > 1), key=lambda kv: (-kv[1], kv[0]))
    want = [[x for x, _ in best if x.isalpha() == plain][:3] for plain in (True, False)]
    assert [set(got.decode().split()[:3]), set(got.decode().split()[3:])] == [set(w) for w in want]
    assert got.decode().split()[2] == want[0][0] and got.decode().split()[-1] == want[1][0]


def test_base_spans_of_a_whole_table_against_brute_force(spark):
    """The contract restated by hand: one scan from the left for each kind, failing matches dropped."""
    word = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")

    def assign(text, i):
        low = text[i:i + 8].translate(common.ASCII_LOWER)
        key = next((k for k in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(k)), None)
        if not key:
            return None
        j = i + len(key)
        j += text[j:j + 1] in ("'", '"') and text[j:j + 1] != ""
        while text[j:j + 1] == " ":
            j += 1
        if text[j:j + 1] not in (":", "="):
            return None
        j += 1
        while text[j:j + 1] == " ":
            j += 1
        j += text[j:j + 1] in ("'", '"') and text[j:j + 1] != ""
        e = j
        while e < len(text) and text[e] in word:
            e += 1
        return (e, e - j >= 12) if e > j else None

    def run(text, i, prefix, letters, least):
        if not text.startswith(prefix, i):
            return None
        e = i + len(prefix)
        while e < len(text) and text[e] in letters:
            e += 1
        return (e, e - i >= least) if e > i + len(prefix) else None

    upper, hexa = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), set("0123456789abcdef")
    kinds = {"assign": assign, "access": lambda t, i: run(t, i, "AKIA", upper, 18), "hex": lambda t, i: run(t, i, "", hexa, 16)}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = [(80_000 + k, t) for k, t in enumerate(["", None, "API_KEY'  =  \"abc.def/ghi+jkl", "api-key=abcdefghijklmnop", "token = = abcdefghijklm",
                                                     "ſecret=abcdefghijklmnop secret:\tabcdefghijklmn", "AKIAAKIA" + "Z9" * 5, "0" * 40_000])]
    rows = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {r.doc_id: r for r in secrets.find_secrets(rows).collect()}
    assert len(got) == rows.count()
    for r in rows.collect():
        text, found = r.text or "", []
        for order, (kind, match) in enumerate(kinds.items()):
            i = 0
            while i < len(text):
                m = match(text, i)
                if m and m[1]:
                    found.append((i, order, kind, m[0]))
                i = m[0] if m else i + 1
        line = ",".join(f"{kind}:{a}:{e}" for a, _, kind, e in sorted(found))
        have = got[r.doc_id]
        assert have.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (r.doc_id, line, have.spans)
        assert (have.n_assign, have.n_access, have.n_hex) == tuple(sum(f[2] == k for f in found) for k in kinds)
        assert set(line.split(",")) - {""} <= set(have.spans.split(","))


def test_mixing(spark, docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    size = Counter()
    for r in rows:
        size[r.source] += r.size
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(size), 1.5 * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= 2 * size[s]}
        if not full:
            target |= share
            break
        target |= {s: 2.0 * size[s] for s in full}
        left -= sum(2.0 * size[s] for s in full)
        free -= full
    for s in size:
        mine = [r for r in rows if r.source == s]
        assert mine[0].target == pytest.approx(target[s])
        assert abs(sum(r.taken for r in mine) - target[s]) <= 0.5 * max(r.size for r in mine) * 2 + 1e-6
        assert all(r.taken in (0, r.size, 2 * r.size) for r in mine)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and mixing.mix(empty).count() == 0


def test_pivotal_rounding_keeps_expectations(spark):
    units = spark.range(400).selectExpr("'s' source", "id", "1 + id % 7 size", "1L m", "0.3D p")
    taken = [mixing.pivotal_round(units, seed=k).agg(F.sum(F.col("x") * F.col("size")), F.sum("x")).collect()[0] for k in range(3)]
    words = sum(0.3 * (1 + i % 7) for i in range(400))
    assert all(abs(t[0] - words) <= 4 for t in taken) and all(80 <= t[1] <= 160 for t in taken)


def test_sharding(spark, docs, empty):
    rows = sharding.shard_documents(docs, rows_per_bucket=17).collect()
    n = docs.count()
    assert len(rows) == n and {r.shard for r in rows} == set(range(40))
    per = Counter(r.shard for r in rows)
    assert max(per.values()) - min(per.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(per[s])) for s in per)
    of = Counter(r.source for r in rows)
    mix = Counter((r.shard, r.source) for r in rows)
    assert all(abs(mix[s, x] - of[x] * per[s] / n) <= 1.5 for s in per for x in of)
    a, b = sharding.shard_documents(docs), sharding.shard_documents(docs.repartition(6))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and sharding.shard_documents(empty).count() == 0


def test_sharding_law_against_brute_force_with_a_third_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "NUMBERS_AT_ONCE", 7)
    monkeypatch.setattr(sharding, "BUCKETS_AT_ONCE", 3)
    rows = spark.range(1_200).selectExpr(
        "if(id % 3 = 0, null, id) id", "if(id % 3 = 0, null, concat('s', id % 4)) source",
        "if(id % 3 = 0, 16, id % 50) size", "id % 3 _h", "'x' _copy", "1 row", "2 slot")
    got = sharding.interleave(rows, n_shards=7, rows_per_bucket=20).collect()
    assert sorted(got[0].asDict()) == ["_copy", "_h", "frac", "id", "row", "shard", "size", "slot", "source"]
    per = Counter(r.shard for r in got)
    assert len(got) == 1_200 and max(per.values()) - min(per.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(per[s])) for s in per)
    of = Counter(r.source for r in got)
    for source, n in of.items():                   # the fractional ranks of a source are all its odd steps, each once
        assert sorted(r.frac for r in got if r.source == source) == [(2 * k + 1) / (2 * n) for k in range(n)]
    sequence = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.frac for r in sequence] == sorted(r.frac for r in got)
    drawn = sharding.interleave(rows, n_shards=7, rows_per_bucket=20)
    again = sharding.interleave(rows.repartition(5), n_shards=7, rows_per_bucket=20)
    assert sorted(map(str, drawn.collect())) == sorted(map(str, again.collect()))


def test_sharding_spreads_equal_rows_over_the_hash_buckets(spark):
    rows = spark.range(6_000).selectExpr("if(id < 3000, null, id) id", "'s' source")
    got = sharding.interleave(rows, n_shards=6, rows_per_bucket=100).collect()
    assert all(350 < sum(r.shard == s and r.id is None for r in got) < 650 for s in range(6))


def test_licenses(spark, docs, empty):
    texts = ["Some text.\nReleased under the MIT License.", "THIS!! WORK!! IS!! LICENSED!! UNDER!! THE!! GNU!! GENERAL!! PUBLIC!! LICENSE,!! VERSION!! 3.",
             "Licensed under the Open Wombat Licence of 1987.", "the work is done and the version is new", None, ""]
    df = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame([(50_000 + i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA))
    got = {(r.doc_id, r.paragraph): r for r in licenses.scan_licenses(df).collect()}
    assert got[50_000, 1].family == "MIT" and got[50_000, 1].confirmed
    assert got[50_001, 0].family == "GPL-3.0"
    assert (50_002, 0) not in got or got[50_002, 0].family == "unknown"
    assert not {50_003, 50_004, 50_005} & {k[0] for k in got}
    assert licenses.scan_licenses(empty).count() == 0


def test_licenses_wrapped_at_72_columns_behind_comment_marks(spark):
    plain = "This module adds numbers and prints what came out of it."
    rows, want = [], {}
    for family, notices in licenses.NOTICES.items():
        for notice in notices:
            for mark in ("# ", " * ", "// ", ""):
                lines = [mark + x for x in textwrap.wrap(notice, 72)]
                want[len(rows)] = (family, len(lines))
                rows.append((len(rows), "\n".join([mark + plain, mark.strip(), *lines, "", "x = 1", "y\x01\x1e = 2"])))
    got = {}
    for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
            "*", "1 id", "2 number", "3 block", "4 unit", "5 words")).collect():
        got.setdefault(r.doc_id, []).append(r)
    for k, (family, n) in want.items():
        assert [(r.family, r.confirmed) for r in got.get(k, [])] == [(family, True)], (rows[k], got.get(k))
        assert got[k][0].paragraph in range(2, 2 + n) and got[k][0].n_lines in (1, n)


def test_licenses_repeat_with_repeated_rows_and_tell_neighbours_apart(spark, docs):
    text = "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."
    long = "\n".join(f"value{k} = {k} + 1" for k in range(20_000))
    rows = [(1, text), (1, text), (None, text), (2, f"{long}\n{text}\n{long}"), (3, "a\n" * 20_000), (4, None), (5, "")]
    rows = [(None if k is None else 60_000 + k, t) for k, t in rows]
    plain = docs.where("doc_id < 9000").select(F.lit(-1).cast("long").alias("doc_id"), "text")      # learned as plain text
    scanned = licenses.scan_licenses(plain.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    got = [(None if r.doc_id is None else r.doc_id - 60_000, r) for r in scanned if r.doc_id != -1]
    assert Counter((k, r.paragraph, r.n_lines, r.family) for k, r in got) == Counter(
        {(1, 0, 1, "MIT"): 2, (1, 1, 1, "Apache-2.0"): 2, (None, 0, 1, "MIT"): 1, (None, 1, 1, "Apache-2.0"): 1,
         (2, 20_000, 1, "MIT"): 1, (2, 20_001, 1, "Apache-2.0"): 1})


def test_chunks_find_every_passage_of_51_words(spark):
    rows, want = [], {}
    for seed in range(150):
        rng = np.random.default_rng(seed)
        size = 1 if seed < 20 else 4

        def words(n, most):
            return ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, most + 1))) for _ in range(n)]

        passage = " ".join(words(51, size))
        for k in (2 * seed, 2 * seed + 1):
            lead, tail = " ".join(words(30, 9)) + " ", " " + " ".join(words(30, 9))
            rows.append((k, lead + passage + tail, "en", "s", 1))
            want[k] = (len(lead), len(lead) + len(passage))
    got = {r.doc_id: r for r in chunks.find_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == set(want)
    for k, (start, end) in want.items():
        assert 0 <= start - got[k].start <= 2 and 0 <= got[k].end - end <= 2, k
        assert got[k].n_cut_chars == (got[k].end - got[k].start if k % 2 else 0) and got[k].first_id == k - k % 2


def test_templates_find_items_with_edited_words(spark):
    rng = np.random.default_rng(2)
    items, rows = [], []
    for k in range(60):
        words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j)}" for j in range(20)]
        items.append((k, " ".join(words)))
        for n in (1, 2, 3):                                # edits close together leave a window of 8 whole
            at = int(rng.integers(9, 12))
            for j in range(n):
                edited = ([*words[:at], "changed", *words[at + 1:]], [*words[:at], "added", *words[at:]],
                          words[:at] + words[at + 1:])[int(rng.integers(0, 3))]
                words, at = edited, at + 1
            rows.append((100 * n + k, "Some text before it. " + " ".join(words) + " and after it", "en", "s", 1))
            words = items[k][1].split()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = templates.contaminated(spark.createDataFrame(rows, SCHEMA), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, d % 100) for d, *_ in rows}


def test_templates_find_copies_of_plain_poor_and_opening_name_items(spark):
    texts = ["What is 12 * 30 + 4?", "Anna has 3 apples, 5 pears, 7 plums", "Which river runs through the old town?"]
    bench = spark.createDataFrame([*enumerate(texts)], "item_id long, text string")
    rows = [(k, f"they asked: {t} and so on", "en", "s", 1) for k, t in enumerate(texts)]
    rows += [(9, "what is 13 * 30 + 5? Nobody knows which river that is", "en", "s", 1)]
    got = templates.contaminated(spark.createDataFrame(rows, SCHEMA), bench).collect()
    assert {(r.doc_id, r.item_id, r.slots_changed) for r in got} == {(k, k, False) for k in range(3)}


def test_secrets_in_joined_names_without_digits_and_before_the_cue():
    key = "Zk" + "vQxHLmTjrWpGYbNncDsA"
    for text in (f"accessKey={key}", f"AccountKey={key};", f"encryptionKey: {key}", f"auth_key {key}", f"{key} is the secret"):
        at = text.index(key)
        assert (at, 3, at + len(key)) in secrets.scan_text(text, b""), text
    assert not secrets.scan_text("the key is internationalization or responsibilities", b"internationalization responsibilities")


def test_long_keys_over_small_alphabets_are_novel():
    rng = np.random.default_rng(4)
    for alphabet in ("0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        for n in (40, 64, 96, 128, 512):
            key = "".join(alphabet[x] for x in rng.integers(0, len(alphabet), n))
            assert secrets.novelty(key.encode(), b"", b"") >= 0.95
            assert (14, 3, 14 + n) in secrets.scan_text(f"the auth_key: {key}", b"")
    assert secrets.novelty(b"get_value_of_item_" * 40, b"", b"") < 0.3


def test_templates_find_a_very_long_item_copied_whole(spark):
    """An item of 20,000 tokens, copied into a text with edits and numbers changed, beside short items and texts."""
    rng = np.random.default_rng(8)
    words = [f"w{a}" for a in "abcdefghijklmnopqrstuvwxyz"]
    long_item = " ".join(f"{rng.choice(words)}{chr(97 + int(rng.integers(0, 26)))}{chr(97 + int(rng.integers(0, 26)))}x"
                         if rng.random() > 0.02 else str(rng.integers(0, 9)) for _ in range(20_000))
    tokens = long_item.split()
    edited = tokens[:300] + ["added"] * 3 + tokens[300:9_000] + tokens[9_005:]
    bench = spark.createDataFrame([(1, long_item), (2, "Every day the red fox jumps over nine lazy dogs near here.")],
                                  "item_id long, text string")
    rows = [(1, "Before it. " + long_item + " after it", "en", "s", 1), (2, " ".join(edited), "en", "s", 1),
            (3, " ".join(rng.permutation(tokens)), "en", "s", 1), (4, "x " * 50_000, "en", "s", 1),
            (5, "Every day the red fox jumps over nine lazy dogs near here.", "en", "s", 1), (None, long_item, "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("found", F.lit(1)).withColumn("item", F.lit("x"))
    got = {(r.doc_id, r.item_id): r for r in templates.contaminated(df, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (5, 2), (None, 1)}
    assert got[1, 1].coverage == 1.0 and got[2, 1].coverage > 0.99


def test_unlinked_near_copies_make_few_rows(spark):
    """Near copies that do not link with each other: pairs that become rows stay far below all pairs."""
    from pyspark.sql import Row

    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(300):
        words = list(base)
        for at in rng.choice(200, 9, replace=False):           # nine edits of five shingles each: no two link
            words[at] = f"x{k}_{at}"
        rows.append(Row(doc_id=k, text=" ".join(words)))
    df = spark.createDataFrame(rows)
    sets = {r.doc_id: {tuple(r.text.split()[i:i + 5]) for i in range(196)} for r in rows}
    linked = sum(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a in range(300) for b in range(a))
    kept = []
    plain = jaccard.materialize

    def counted(frame, name="intermediate"):
        out = plain(frame, name)
        if name == "sketched_pairs":
            kept.append(out.count())
        return out

    jaccard.materialize = counted
    try:
        got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df).collect()}
    finally:
        jaccard.materialize = plain
    assert linked == 0 and got == {k: k for k in range(300)}
    assert sum(kept) <= 300 * 299 / 2


def test_repeats_hold_a_run_of_one_byte(spark):
    """A passage with a long run of one character inside, and one of 51 short words, in three texts each."""
    rng = np.random.default_rng(12)

    def noise(n):
        return " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))

    passages = [noise(15) + " " + "z" * 700 + " " + noise(15), " ".join(rng.choice(list("abcdefghijk"), 51))]
    rows, where = [], {}
    for k in range(6):
        head, text = noise(40 + k), passages[k % 2]
        rows.append((k, f"{head} {text} {noise(30)}", "en", "s", 1))
        where[k] = (len(head) + 1, len(head) + 1 + len(text))
    found = {r.doc_id: r for r in chunks.find_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(found) == set(where)
    for k, (start, end) in where.items():
        assert found[k].start <= start + 1 and found[k].end >= end - 1
        assert found[k].first_id == k % 2 and found[k].end - found[k].start <= end - start + 4


def test_contexts_move_no_text_after_the_cut(spark):
    rows = [(1, "one text of many words", 5), (1, "one text of many words", 5), (None, "another text here", 9), (2, "not wanted", 3)]
    texts = spark.createDataFrame(rows, "id long, text string, row long")
    wanted = spark.createDataFrame([(1, 5, 3), (1, 5, 8), (None, 9, 7)], "id long, row long, at int")
    cut = chunks._contexts(texts, wanted)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("MapInArrow")]
    got = sorted(((r.id, r.row, r.at, r.before, r.after) for r in cut.collect()), key=str)
    assert got == [(1, 5, 3, "one", " text of many words"), (1, 5, 8, "one text", " of many words"), (None, 9, 7, "another", " text here")]


def test_repeats_write_the_own_contexts_before_the_second_join(spark):
    passage = " ".join(f"word{i} of{i % 7}" for i in range(60))
    docs = spark.createDataFrame([(1, passage), (2, "start here " + passage), (None, "or there " + passage)], "doc_id long, text string")
    plain, names = chunks.materialize, []

    def noted(df, name):
        names.append(name)
        return plain(df, name)

    chunks.materialize = noted
    try:
        got = chunks.find_repeats(docs).collect()
    finally:
        chunks.materialize = plain
    assert {r.doc_id for r in got} == {1, 2, None} and names.index("own_contexts") < names.index("segments")


def test_contexts_carry_what_their_request_holds(spark):
    texts = spark.createDataFrame([(1, "one text of many words", 5), (None, "another text here", 9)], "id long, text string, row long")
    wanted = spark.createDataFrame([(1, 5, 3, 7, True), (1, 5, 3, 7, True), (1, 5, 3, None, None), (None, 9, 7, 8, False)],
                                   "id long, row long, at int, segment long, opens boolean")
    got = sorted(((r.id, r.at, r.segment, r.opens, r.before, r.after) for r in chunks._contexts(texts, wanted).collect()), key=str)
    assert got == [(1, 3, 7, True, "one", " text of many words"), (1, 3, None, None, "one", " text of many words"),
                   (None, 7, 8, False, "another", " text here")]


def test_repeats_write_contexts_once(spark):
    rng = np.random.default_rng(5)
    passage = " ".join(f"w{x}" for x in rng.integers(0, 10 ** 6, 80))
    docs = spark.createDataFrame([(1, passage), (2, "start here " + passage), (3, passage + " and on " + passage)], "doc_id long, text string")
    plain, names = chunks.materialize, []
    chunks.materialize = lambda df, name: names.append(name) or plain(df, name)
    try:
        got = {(r.doc_id, r.start, r.end, r.first_id) for r in chunks.find_repeats(docs).collect()}
    finally:
        chunks.materialize = plain
    assert [n for n in names if "contexts" in n] == ["own_contexts"]
    n = len(passage)
    assert (1, 0, n, 1) in got and (2, 11, 11 + n, 1) in got


def test_extents_share_what_commonprefix_shares():
    from os.path import commonprefix

    rng = np.random.default_rng(6)
    for _ in range(3000):
        a = "".join(rng.choice(list("ab \u00e9\U0001F600"), int(rng.integers(0, 20))))
        b = a[:int(rng.integers(0, 20))] + "".join(rng.choice(list("ab "), int(rng.integers(0, 4))))
        assert chunks._shared(a, b) == len(commonprefix((a, b)))


def test_cuts_are_the_smallest_hashes_in_order():
    gear = chunks.gear_table()
    for text in ("z" * 300, "ab c" * 90, "\u6f22\u5b57 " * 120, " ".join(f"w{i * i}" for i in range(200))):
        data = text.encode()
        cuts = chunks._cuts(data, gear).tolist()
        assert cuts == sorted(set(cuts)) and all((data[c] & 0xC0) != 0x80 for c in cuts if c < len(data))


def test_contract_deals_rows_out_once_a_round(spark):
    rng = np.random.default_rng(7)
    edges = [(i, i + 1) for i in range(40)] + [(int(a), int(a) + 1) for a in rng.integers(100, 130, 60)]
    plain, plans = jaccard.materialize, []

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning")))
        return plain(df, name)

    jaccard.materialize = noted
    try:
        got = {r.v: r.root for r in jaccard.contract(spark.createDataFrame(edges * 3, "a long, b long")).collect()}
    finally:
        jaccard.materialize = plain
    root = {v: v for e in edges for v in e}
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert sum(n for _, n in plans) == sum(n > 0 for _, n in plans) and {x for x, n in plans if n} == {"hooks"}


def test_verify_gives_each_pair_once(spark):
    words = [f"w{i}" for i in range(30)]
    texts = {1: " ".join(words), 2: " ".join(words[:-1]), 3: " ".join(words[3:])}
    naming = jaccard.Naming()
    sets = {i: jaccard.shingle_set(t.encode(), jaccard._WordHashes()) for i, t in texts.items()}
    name = {i: naming(s) for i, s in sets.items()}
    rows = [*texts.items(), (2, texts[2]), (2, "another text under the same id"), (1, texts[1])]
    pairs = spark.createDataFrame([(name[1], 1, name[u], u, 10, 20) for u in (2, 3)], "p long, pid long, u long, id long, a long, b long")
    got = jaccard.verify(pairs, spark.createDataFrame(rows, "id long, text string"), naming)
    want = [(name[1], name[u], 10, 20, len(sets[1]), len(sets[u]), len(np.intersect1d(sets[1], sets[u]))) for u in (2, 3)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
