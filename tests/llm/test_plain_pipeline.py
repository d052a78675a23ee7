"""Every pipeline stage against a plain version of it, and the URL tree against one built by hand in Python."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import bpe_sql, oracle, quality, queries, secrets, url_templates

words_of = lambda t: [w for w in re.split("[ \t-\r]+", t or "") if w]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Rows before the first stage and after each, and the last input of `mix` as a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (-1, "", "en", "src0", 0), (-1, "", "en", "src0", 0),
         (-2, " ".join(f"w{i % 7}{i}" for i in range(30_000)), "en", None, 1), (-3, "no spaces " + "x" * 200_000, "en", "src1", 1)], docs.schema)
    # Distinct ids, so that stages can be told what became of each text.
    kept, seen = docs.unionByName(odd), []
    folder = str(tmp_path_factory.mktemp("stages"))
    seen.append(kept.collect())
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept, sf_dir).write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
        seen.append(kept.collect())
    return dict(zip(["documents", *(name for name, _ in corpus_pipeline.STAGES)], seen)), folder


def test_quality_rules_by_hand(spark, sf_dir, stages):
    rows, _ = stages
    trusted = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()}
    docs = spark.createDataFrame(rows["documents"], "doc_id long, text string, lang string, source string, n_chars long")
    grams = [(r.doc_id, r.b) for r in docs.select("doc_id", quality.ngram_buckets("text").alias("b")).collect()]
    n = quality.BUCKETS
    raw, good = np.zeros(n), np.zeros(n)
    for i, b in grams:
        np.add.at(raw, b, 1)
        np.add.at(good, b, i in trusted)
    weight = np.log((good + 1) / (good.sum() + n)) - np.log((raw + 1) / (raw.sum() + n))
    ratios = {(i, len(b)): np.mean(weight[b]) if b else None for i, b in grams}
    by_grams = {r.doc_id: r.n for r in docs.select("doc_id", F.size(quality.ngram_buckets("text")).alias("n")).collect()}

    def plain(r):
        words = words_of(r.text)
        three = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        count = Counter(three)
        repeated = len({i + k for i, g in enumerate(three) if count[g] > 1 for k in range(3)})
        ratio = ratios.get((r.doc_id, by_grams[r.doc_id]))
        return len(words) >= 50 and 100 * repeated <= 50 * len(words) and ratio is not None and ratio >= quality.THRESHOLD

    assert Counter(map(str, rows["quality_rules"])) == Counter(str(r) for r in rows["documents"] if plain(r))


def test_near_duplicates_by_hand(stages):
    rows, _ = stages
    before = rows["quality_rules"]
    sets = []
    for r in before:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), r.text).split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    root = list(range(len(before)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    places = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            places[g].add(i)
    pairs = {(i, j) for own in places.values() for i in own for j in own if i < j}
    for i, j in pairs:
        common = len(sets[i] & sets[j])
        if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    groups = defaultdict(list)
    for i, r in enumerate(before):
        groups[find(i)].append(r.doc_id)
    assert sorted(r.doc_id for r in rows["near_duplicates"]) == sorted(min(g) for g in groups.values())
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text == texts[r.doc_id] for r in rows["near_duplicates"]) and len(groups) < len(before)


def test_secret_scan_by_hand(stages):
    rows, _ = stages
    after = {r.doc_id: r for r in rows["secret_scan"]}
    assert len(after) == len(rows["near_duplicates"])
    hidden = 0
    for r in rows["near_duplicates"]:
        spans = [m.span() for m in re.finditer(secrets.BASE[0].pattern, r.text, re.A | re.I) if len(m[2]) >= 12]
        spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]+", r.text) if len(m[0]) >= 18]
        spans += [m.span() for m in re.finditer("[0-9a-f]+", r.text) if len(m[0]) >= 16]
        for rule in secrets.FURTHER:
            spans += [m.span() for m in re.finditer(rule.pattern, r.text)]
        out, at = "", 0
        for start, end in sorted(spans):
            if start >= at:
                out += r.text[at:start] + "<secret>"
            at = max(at, end)
        assert after[r.doc_id].text == out + r.text[at:]
        assert after[r.doc_id].n_chars == len(after[r.doc_id].text)
        hidden += bool(spans)
    assert hidden > 3


def test_mix_by_its_sql(stages):
    """What the SQL of the mix says of the same documents, in words; and no word but the document's own, in order."""
    rows, folder = stages
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/secret_scan/*.parquet'")
    want = {i: taken for i, _, _, _, taken in con.execute(oracle.ORACLES["op7_block_mix"]).fetchall()}
    texts = {r.doc_id: r.text for r in rows["secret_scan"]}
    got = Counter()
    for r in rows["mix"]:
        own = iter(words_of(texts[r.doc_id]))
        mine = words_of(r.text)
        assert all(any(w == x for x in own) for w in mine)
        got[r.doc_id] += len(mine)
    assert {i: n for i, n in want.items() if n} == dict(got) and set(Counter(r.doc_id for r in rows["mix"]).values()) <= {1, 2}


def test_encode_like_the_library(stages):
    rows, _ = stages
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_sql.read_ranks(P.path(queries.MULTI)), special_tokens={})
    want = Counter((r.doc_id, r.lang, r.source, tuple(own.encode_ordinary(r.text))) for r in rows["mix"])
    assert Counter((r.doc_id, r.lang, r.source, tuple(r.ids)) for r in rows["encode"]) == want
    assert all(r.n_tokens == len(r.ids) for r in rows["encode"])


def test_stages_of_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), sf_dir)
        assert out.count() == 0, name
        assert name == "encode" or out.columns == corpus_pipeline.COLUMNS


def plain_tree(pages):
    """Purity of each page's template: (host, segments, label or None) a page."""
    hosts = defaultdict(list)
    for page in pages:
        hosts[page[0]].append(page)
    labels = [x for _, _, x in pages if x is not None]
    share = sum(labels) / len(labels) if labels else 0.0
    out = {}
    for host, own in hosts.items():
        counted = Counter(tuple(s) for _, s, _ in own)
        children, n_below = defaultdict(set), Counter()
        for s, n in counted.items():
            for d in range(len(s)):
                children[d, s[:d]].add(s[d])
                n_below[d, s[:d]] += n
        wild = {k for k, c in children.items() if len(c) >= url_templates.FAN and len(c) >= url_templates.FAN_SHARE * n_below[k]}
        final = {s: tuple("*" if (d, s[:d]) in wild else x for d, x in enumerate(s)) for s in counted}
        stats = defaultdict(lambda: [0, 0])
        for _, s, x in own:
            t = final[tuple(s)]
            stats[t][0] += x or 0
            stats[t][1] += x is not None
        branch_of = {}
        for t in stats:
            fixed = [i for i, x in enumerate(t) if not x.startswith("*")]
            branch_of[t] = tuple("?" if fixed and i == fixed[-1] else x for i, x in enumerate(t))
        for t, (bad, n) in stats.items():
            together = [stats[u] for u in stats if branch_of[u] == branch_of[t]]
            all_bad, all_n = (sum(x[k] for x in together) for k in (0, 1))

            def alike(b, m):
                if not m:
                    return True
                shared = all_bad / all_n
                error = (shared * (1 - shared) / m + 0.25 / (m + 1) / all_n) ** 0.5
                return abs(b / m - shared) <= url_templates.ALIKE * error

            pool = [x for x in together if alike(*x)]
            pool_bad, pool_n = (sum(x[k] for x in pool) for k in (0, 1))
            host_bad, host_n = (sum(x[k] for x in stats.values()) for k in (0, 1))
            b, m = (bad, n) if not alike(bad, n) else (pool_bad, pool_n) if pool_n else (host_bad, host_n)
            purity = (b + url_templates.SMOOTHING * share) / (m + url_templates.SMOOTHING)
            out[host, t] = ("/".join(t), purity, m > 0 and purity >= url_templates.REJECTED)
        for s, t in final.items():
            out[host, "plain", s] = out[host, t]
    return out


def test_url_tree_by_hand(spark):
    rng = np.random.default_rng(9)
    urls = []
    for i in range(1500):
        host = f"h{rng.integers(4)}.com"
        kind = rng.choice(["news", "shop", "spam", "user"])
        tail = [f"{rng.integers(10**6)}.html", f"name{rng.integers(400)}", "index", f"{hashlib.md5(str(i).encode()).hexdigest()}"][rng.integers(4)]
        urls.append((i, f"http://{host}/{kind}/{tail}" + ("/more" if rng.random() < 0.2 else "") + ("?q=1" if rng.random() < 0.1 else ""),
                     int(rng.random() < (0.9 if kind == "spam" else 0.1)) if rng.random() < 0.5 else None))
    urls += [(-1, None, None), (-2, "", None), (-3, "http://h0.com", 1), (-4, "http://h0.com/", 0), (-5, "http://alone.org/a/b", None)]
    df = spark.createDataFrame(urls, "page_id long, url string, mark int")
    got = {r.page_id: r for r in url_templates.judge(df, (), labelled=F.col("mark")).collect()}
    generic = re.compile(r"^([0-9]+|[0-9a-f]{8,}|[0-9a-f-]{32,})(?=$|\.[A-Za-z0-9]+$)")
    pages = []
    for i, _, mark in urls:
        segments = [generic.sub("*", s) for s in got[i].path.split("/") if s]
        pages.append((got[i].host, segments, mark))
    want = plain_tree(pages)
    for (i, _, _), (host, segments, _) in zip(urls, pages):
        template, purity, blocked = want[host, "plain", tuple(segments)]
        assert (got[i].template, got[i].verdict) == (template, "block" if blocked else "allow"), (i, got[i])
        assert abs(got[i].purity - purity) < 1e-9
    assert 100 < sum(r.verdict == "block" for r in got.values()) < 700
