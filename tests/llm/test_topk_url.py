"""Top-k search and url rules against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewatch.llm import topk, url_filter


def brute(rows, k, scale=1024):
    ok = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if i % 10 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("dim,block", [(40, 8192), (7, 3), (16, 1)])
def test_top_k(spark, dim, block):
    rnd = np.random.default_rng(dim)
    rows = [(i, (rnd.normal(size=dim) / 3).round(1 if i % 3 else 3).astype(np.float32).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    for stretch in (64 << 20, 1):
        got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 10 == 0, 6, block=block, stretch_bytes=stretch).collect()))
        assert got == brute(rows, 6)


def test_top_k_plan_and_tasks_do_not_grow_with_the_queries(spark, tmp_path):
    import pyarrow as pa
    df = spark.range(400).select(F.col("id").alias("vec_id"), F.array(*[F.rand(i) for i in range(5)]).alias("embedding"))
    few, many = (topk.top_k(df, F.col("vec_id") % n == 0, block=7)._jdf.queryExecution().optimizedPlan().toString() for n in (100, 1))
    assert few.count("MapInArrow") == many.count("MapInArrow") == 1 and "Union" not in many
    spark.range(50).select(F.col("id").alias("vec_id"), F.array(F.col("id")).alias("v")).repartition(3).write.parquet(f"{tmp_path}/q")
    parts = list(topk._blocks(f"{tmp_path}/q", 7))
    assert max(p.num_rows for p in parts) <= 7 and sorted(i for p in parts for i in p["vec_id"].to_pylist()) == list(range(50))
    batch = pa.RecordBatch.from_pydict({"vec_id": [1, 2], "v": [[1], [2]]})
    assert [t.num_rows for t in topk._stretches(iter([batch] * 5), 2 * batch.nbytes)] == [4, 4, 2]


def test_top_k_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (10, [1.0, 2.0]), (10, [0.5, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (4, None), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [9.0, 9.0]), (20, []), (21, []), (30, [1.0, 1.0, 1.0]), (8, [-1.0, -2.0])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 10 == 0, 3).collect()))
    assert got == brute(rows, 3)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0, 3).count() == 0


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("a.net", "/es/", "allow"), ("org", "", "block"), ("x.org", "/p", "allow")]


def judged(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


@pytest.mark.parametrize("limit", [256 << 20, 0])
def test_urls(spark, limit):
    rnd = random.Random(8)
    urls = [None, "", "no scheme.com/en/", "http://", "http:///x", "HTTP://EXAMPLE.COM/en/a?b#c", "x://notexample.com/en/", "http://com/",
            "http://com", "http://example.com/en", "http://é.net/es/ü", "http://org", "http://x.org/pq", "a://b://c.com/", "http://a.net/es/\n/x"]
    for _ in range(300):
        host = ".".join(rnd.choices(["www", "example", "Example", "a", "net", "com", "org", "x"], k=rnd.randrange(1, 4)))
        urls.append(f"http://{host}{rnd.choice(['', '/', '/en/', '/es/x', '/EN/', '/p'])}{rnd.choice(['', '?q=/en/', '#f'])}")
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)] + [(None, urls[5], "z")], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = url_filter.judge(df, rules, max_bytes=limit).collect()
    assert len(out) == len(urls) + 1
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == judged(urls[5 if r.page_id is None else r.page_id])
    assert url_filter.judge(df.limit(0), rules, max_bytes=limit).count() == 0
    assert {r.verdict for r in url_filter.judge(df, rules.limit(0), "block", max_bytes=limit).collect()} == {"block"}


def test_collision_is_not_a_match(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: 42 if s[0] in "ab" else 7)
    (tmp_path / "i").write_bytes(url_filter.build([("a.com", "/", "block"), ("b.com", "/", "allow")]))
    index = url_filter.DigestArray(str(tmp_path / "i"))
    found = index.find(["a.com\n/", "b.com\n/", "aa.com\n/", "zz\n/"])
    assert [index.key(i) if i >= 0 else None for i in found] == ["a.com\n/", "b.com\n/", None, None]


def test_very_long_urls_take_bounded_memory(spark):
    import tracemalloc

    from scorewatch.llm import url_filter
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("a.b.c.d.example.com", "/x", "block"), ("net", "/" + "y" * 50, "block")]
    hosts = ["a." * 500_000 + "example.com", "." * 1_000_000 + "com", "x" * 1_000_000, "b.c.d.example.com", "a.b.c.d.example.com", ".example.com", ""]
    urls = [f"http://{h}{p}" for h in hosts for p in ("/en/" + "z" * 1_000_000, "/x", "/")]
    path = url_filter.build(rules)
    import tempfile
    with tempfile.NamedTemporaryFile() as f:
        f.write(path), f.flush()
        index = url_filter.DigestArray(f.name)
        tracemalloc.start()
        found = [url_filter.probes(h, "/en/" + "z" * 1_000_000, index) for h in hosts]
        assert tracemalloc.get_traced_memory()[1] < 8 << 20 and max(map(len, found)) <= 3 * 4
        tracemalloc.stop()
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    by_index = sorted(map(tuple, url_filter.judge(frame, listed).collect()))
    assert by_index == sorted(map(tuple, url_filter.judge(frame, listed, max_bytes=0).collect()))

    def brute(host, path):
        fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits, key=lambda x: len(x[0])) if fits else (None, "allow")

    want = [brute(h, p) for h in hosts for p in ("/en/" + "z" * 1_000_000, "/x", "/")]
    assert [(r[3], r[4]) for r in by_index] == want
