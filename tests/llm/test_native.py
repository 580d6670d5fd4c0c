import datetime as dt
import random
import re

import pytest

from oracle import assert_matches
from quernstone.llm import chat, urls


def test_oracles(spark, sf_dir):
    assert_matches(spark, "op1_chat", sf_dir)
    assert_matches(spark, "op10_urls", sf_dir)


def rendered(turns, person, context=("system",)):
    clean = lambda t: (t or "").replace("<|", "< |")
    name = lambda s: re.sub(r"[\r\n]+", " ", clean(s)).replace("|>", "| >")
    turns = [(t, name("unknown" if s is None else s), clean(m)) for t, s, m in turns]
    turns.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2]))
    return [(f"<|assistant|>\n" if s == person else "<|system|>\n" if s in context else f"<|user name={s}|>\n") + m + "<|end|>\n" for _, s, m in turns]


def test_perspectives_by_brute_force(spark):
    rng = random.Random(2)
    people = ["ann", "bo", "système", None, "system", "<|end|>", "a|>\n<|b"]
    rows = [(c, rng.choice([None, *range(40)]), rng.choice(people), rng.choice([None, "", "hi", "<|assistant|>\nno", "é" * 9]), "x") for c in [1, 2, None] for _ in range(60)]
    rows += rows[:9] + [(5, 0, "system", "alone", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    got = {}
    for block, block_rows in ((4, 1 << 16), (1024, 1 << 16), (16, 5)):
        out = chat.perspectives(df, block=block, block_rows=block_rows).collect()
        got[block] = sorted(map(tuple, out), key=repr)
        for conv in (1, 2, None):
            turns = [(t, s, m) for c, t, s, m, _ in rows if c == conv]
            for person in ["ann", "bo", "système", "unknown", "< |end| >", "a| > < |b"]:
                mine = sorted((r for r in out if r.conv_id == conv and r.perspective == person), key=lambda r: r.position)
                whole = "".join(r.segment for r in mine)
                assert [r.segment for r in mine] == rendered(turns, person)
                assert [r.position for r in mine] == list(range(len(mine)))
                assert all(whole[r.start : r.end] == r.segment and r.learn == (r.speaker == person) for r in mine)
                assert all(whole[r.learn_start : r.learn_end] == r.segment.removeprefix("<|assistant|>\n") for r in mine if r.learn)
        assert not [r for r in out if r.conv_id == 5]
    assert got[4] == got[1024] == got[16]
    for r in chat.dialogues(chat.perspectives(df), 7).collect():
        turns = [(t, s, m) for c, t, s, m, _ in rows if c == r.conv_id]
        whole = "".join(rendered(turns, r.perspective))
        assert whole[r.start : r.start + len(r.rendered)] == r.rendered and "".join(rendered(turns, r.perspective)[7 * r.part : 7 * r.part + 7]) == r.rendered
        assert all(whole[a - 14 : a] == "<|assistant|>\n" and whole[:b].endswith("<|end|>\n") for a, b in r.spans)
    assert chat.perspectives(df.limit(0)).collect() == []


def test_turns_without_numbers_are_spread(spark):
    from pyspark.sql import functions as F

    rows = spark.range(100_000).selectExpr("cast(null as long) conv_id", "cast(null as long) turn", "if(id % 3 = 0, 'ann', 'bo') role", "if(id % 4 = 0, 'same', 'a message ' || id) text")
    said = rows.select(F.col("conv_id").alias("conv"), "turn", F.col("role").alias("speaker"), F.col("text").alias("message"), F.lit(7).alias("block"))
    crowd, rest = chat._crowded(said, 8192)
    assert rest.count() == 0 and crowd.groupBy("sub").count().agg(F.max("count")).first()[0] <= 8192
    out = chat.perspectives(rows, block_rows=8192).filter("perspective = 'ann'")
    n, places, size, end = out.agg(F.count("*"), F.countDistinct("position"), F.sum(F.length("segment")), F.max("end")).first()
    assert (n, places, end) == (100_000, 100_000, size)
    assert out.agg(F.max("position")).first()[0] == 99_999


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def test_url_parts(spark):
    cases = {
        "https://User:pw@WWW.Example.com:8080/a/b?q#f": ("www.example.com", [d + p for d in ("www.example.com", "example.com", "com") for p in ("", "/a", "/a/b")]),
        "//h.org": ("h.org", ["h.org", "org"]),
        "http://h.org./?x=/y": ("h.org", ["h.org", "org"]),
        "http://h.org/a//b/": ("h.org", [d + p for d in ("h.org", "org") for p in ("", "/a", "/a//b")]),
        "no url": ("", None),
        "": ("", None),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    got = {r.url: (r.h, r.k) for r in df.select("url", urls.host_of(df["url"]).alias("h"), urls.keys_of(df["url"]).alias("k")).collect()}
    assert got == cases


@pytest.mark.parametrize("max_bytes", [0, 1 << 25])
def test_verdicts_by_brute_force(spark, max_bytes):
    rng = random.Random(3)
    hosts = ["a.b.com", "b.com", "c.org", "x.c.org"]
    entries = [(rng.choice(["allow", "spam", "bad"]), rng.choice([*hosts, "com", "c.org/en", "c.org/de/x/", "org/de", "x.c.org/de/x/y.html", "b.com/e", "com/"]), rng.choice(["add", "remove", "add", "other", None]), day(rng.randint(0, 400))) for _ in range(90)]
    entries += [(None, "b.com", "add", day(0)), ("spam", None, "add", day(0)), ("spam", "b.com", "add", None), entries[0]]
    captures = [(k, rng.choice([f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de/x', '', 'de/x/y.html', 'de/x/', 'de/xy'])}", None, "bad"]), rng.choice([None, day(rng.randint(-5, 405))]), 1, "k", 3, "c") for k in range(200)]
    captures += captures[:5]
    c = spark.createDataFrame(captures, "page_id long, url string, day date, blocked int, key string, bucket int, copies string")
    e = spark.createDataFrame([(*x, "u") for x in entries], "list string, key string, action string, day date, url string")
    got = {r.page_id: (r.copies, r.n_active, r.matched_list, r.matched_key, r.blocked) for r in urls.verdicts(c, e, max_bytes=max_bytes).collect()}
    assert len(got) == 200
    for k, url, when, *_ in captures:
        found = []
        if url and "//" in url and when:
            host, _, path = url.removeprefix("http://").partition("/")
            keys = [host[i:] for i in range(len(host)) if i == 0 or host[i - 1] == "."]
            folders = path.strip("/").split("/") if path else []
            keys = [x + "".join(f"/{f}" for f in folders[:n]) for x in keys for n in range(len(folders) + 1)]
            for name in ("allow", "spam", "bad"):
                for key in keys:
                    events = sorted((d, a == "add") for n, q, a, d in entries if n == name and q and q.rstrip("/") == key and a in ("add", "remove") and d and d <= when)
                    if events and events[-1][1]:
                        found.append((len(key), name == "allow", name, key))
        top = max(found, default=(0, True, None, None))
        assert got[k] == (2 if k < 5 else 1, len(found), top[2], top[3], bool(found) and not top[1])
    assert urls.verdicts(c.limit(0), e).collect() == [] and not any(r.blocked for r in urls.verdicts(c, e.limit(0)).collect())


def test_intervals(spark):
    rows = [("l", "k", "add", day(3)), ("l", "k", "add", day(5)), ("l", "k", "remove", day(9)), ("l", "k", "remove", day(11)), ("l", "k", "add", day(20)), ("l", "j", "remove", day(1)), ("l", "j", "add", day(1))]
    e = spark.createDataFrame(rows, "list string, key string, action string, day date")
    assert {tuple(r) for r in urls.intervals(e).collect()} == {("l", "k", day(3), day(9)), ("l", "k", day(20), None), ("l", "j", day(1), None)}
