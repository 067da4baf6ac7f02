"""Chat formatting read back, and URL rules against brute force."""

import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.llm import chat, queries, urls

FOLDER = "/root/testdata/sf0.001"
NASTY = st.text(alphabet="a\\|<>n\n é🙂", max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(NASTY, NASTY), min_size=1, max_size=5))
def test_any_text_comes_back(turns):
    roles, texts = (pa.array([t[k] for t in turns], pa.string()) for k in (0, 1))
    raw, turn_at, text_at = chat.assemble(roles, texts)
    whole = raw.tobytes().decode()
    assert list(chat.parse(whole)) == turns
    assert whole.count(chat.START) == len(turns)
    for k, (_, text) in enumerate(turns):
        piece = raw[text_at[k] : turn_at[k + 1] - len(chat.END)].tobytes().decode()
        assert chat.unescape(piece) == text


def _expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        learnt = "".join(text for _, _, role, text in turns if role == "assistant")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(turns), digest(said), len(learnt), digest(learnt))
    return out


def _digests(rows):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def test_the_query_reads_every_conversation_back(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    rows = [tuple(r) for r in rows] + [(-1, 0, "user", queries.FORGED), (-1, 1, "assistant", queries.FORGED)]
    assert _digests(queries.op4_chat(spark, FOLDER).collect()) == _expected(rows)


def test_long_and_odd_conversations(spark, monkeypatch):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t} <|im_end|> é") for t in range(300)]
    rows += [(2, 0, None, None), (2, 0, None, None), (2, 1, "assistant", ""), (None, 1, "assistant", "x"), (None, None, "a\nb", "y")]
    rows += [(3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, 5, "assistant", "a")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({c: F.lit("clash") for c in ("part", "loss")}).repartition(3)
    monkeypatch.setattr(chat, "PART_BYTES", 500)
    formatted = chat.format_conversations(frame)
    parts = formatted.groupBy("conv_id").count().where("conv_id = 1").first()["count"]
    assert parts > 5
    assert _digests(chat.read_back(formatted, ordered=True).collect()) == _expected(rows)
    # Written and read in any order, the parts still give the same.
    found = chat.read_back(formatted.orderBy(F.rand(1))).collect()
    assert _digests(found) == _expected(rows)
    texts = {}
    for r in sorted(formatted.collect(), key=lambda r: r["part"]):
        texts[r["conv_id"]] = texts.get(r["conv_id"], "") + r["text"]
    assert {r["conv_id"]: r["formatted_chars"] for r in found} == {k: len(v) for k, v in texts.items()}
    assert chat.read_back(chat.format_conversations(frame.where("false"))).count() == 0


def _judged(url, rules):
    scheme = (url or "").partition("://")
    rest = scheme[2] if scheme[1] else ""
    host = rest.split("/")[0].split("?")[0].split("#")[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (-len(h + p), -len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = min(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_rules_equal_brute_force(spark):
    rng = random.Random(7)
    labels, paths = ["com", "net", "a", "b", "xn-1", "co"], ["/", "/en/", "/en", "/e", "/en/x/", "/fr/", "/en/x/y"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = {(host(), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    pages = [f"http://{host()}{rng.choice(paths + ['', '/en/x/y/z'])}{rng.choice(['', '?q=/en/', '#x'])}" for _ in range(300)]
    pages += [None, "", "no scheme/en/", "https://A.COM/en/Z", "x://", "http://a.com/en/?u=http://b.net/", "x://É.com/\n/en/"]
    pages += pages[:20]
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string").withColumns(
        {c: F.lit("clash") for c in ("host", "rule", "key", "_key")}
    )
    found = urls.judge(frame, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert {r["page_id"]: tuple(r)[1:] for r in found.collect()} == {i: _judged(u, rules) for i, u in enumerate(pages)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if x in plan]


def test_no_rules_no_pages_null_rules(spark):
    pages = spark.createDataFrame([(None, "http://a.com/"), (1, None)], "page_id long, url string")
    schema = "host string, path string, verdict string"
    none = urls.judge(pages, spark.createDataFrame([], schema))
    assert sorted(map(repr, none.collect())) == sorted(
        map(repr, [none.collect()[0].__class__(page_id=None, host="a.com", path="/", rule=None, verdict="allow"),
                   none.collect()[0].__class__(page_id=1, host="", path="", rule=None, verdict="allow")])
    )
    rules = spark.createDataFrame([(None, "/", "block"), ("com", "/", "block"), ("com", "/", "allow")], schema)
    assert sorted((r["rule"] or "", r["verdict"]) for r in urls.judge(pages, rules).collect()) == [("", "allow"), ("com/", "block")]
    assert urls.judge(pages.where("false"), rules).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, duck, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    relation = duck.sql(queries.ORACLE_SQL[name])
    order = sorted(frame.columns)
    rows = lambda names, data: sorted(repr([r[names.index(c)] for c in order]) for r in data)
    assert sorted(relation.columns) == order
    assert rows(frame.columns, [tuple(r) for r in frame.collect()]) == rows(relation.columns, relation.fetchall())
