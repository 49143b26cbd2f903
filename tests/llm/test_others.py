import base64
import hashlib
import json
import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from outletry.llm import chat, mixing, warc
from outletry.llm.common import fresh_path


def test_targets_and_taken(spark, prose):
    rows = [(i, prose(i, 20 + i % 90), ["b", "a", "c", None, "é", ""][i % 6 if i % 2 else 0]) for i in range(1500)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    m = mixing.mix(d)
    out = m.toPandas()
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = {("" if s is None else "=" + s): t for s, t in plain.targets(sizes).items()}
    for key, g in out.groupby("key"):
        assert abs(g.target.iloc[0] - want[key]) < 1e-6 * want[key] + 1e-9
        assert abs(g.taken.sum() - want[key]) <= max(60, 0.01 * want[key])
    assert (out.taken <= 3 * out["size"]).all()
    again = mixing.mix(d.repartition(5)).toPandas()
    assert dict(zip(again.doc_id, again.taken)) == dict(zip(out.doc_id, out.taken))
    placed = mixing.place(m).toPandas()
    assert placed.groupby("uid")["size"].sum().sum() == out.taken.sum()
    docs = mixing.mixed_documents(d)
    assert docs.columns == d.columns and docs.count() == len(placed)


@pytest.mark.parametrize("quotas", [[], [5], [100, 3, 0, 50], [7] * 40])
def test_split_tree_is_exact(quotas):
    got = mixing.split_tree(quotas, 8, 3)
    assert got.sum(0).tolist() == quotas
    if quotas:
        assert got.sum(1).max() - got.sum(1).min() <= 1 and (got >= 0).all()
    assert np.array_equal(got, mixing.split_tree(quotas, 8, 3))


def test_mix_of_odd_rows(spark, odd_documents):
    out = mixing.mix(odd_documents).collect()
    assert len(out) == 10 and sum(x["size"] for x in out) == 30000 + 3 + 3 + 3 + 4 + 3 + 6
    assert mixing.place(mixing.mix(odd_documents)).count() >= 1
    assert mixing.mixed_documents(odd_documents).columns == odd_documents.columns
    assert mixing.mix(odd_documents.limit(0)).count() == 0
    assert mixing.mixed_documents(odd_documents.limit(0)).count() == 0


def test_warc_round_trip(spark):
    rows = [(3, "http://a/3", "<p>x</p>"), (1, "http://a/1", "<p>x</p>"), (2, None, "ü" * 100_000), (4, "u", None), (5, "u", ""), (None, "n", "<p>x</p>"), (6, "bad\r\nInjected: 1", "\r\n\r\nWARC/1.1")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as sha", "2 as n", "3 as refers_to").repartition(2)
    manifest = warc.write_bundles(d, fresh_path(spark, "warc-test"))
    got = {x["page_id"]: tuple(x)[1:] for x in warc.read_bundles(manifest).collect()}
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    full = {i: h or "" for i, _, h in rows}
    want = {i: (len(h.encode()), digest(h), "revisit" if i in (3, 5) else "response", {3: 1, 5: 4}.get(i)) for i, h in full.items()}
    assert got == want
    for path in [x["path"] for x in manifest.collect()]:
        b = warc.Bundle(path)
        for page in b.places:
            ((head, payload),) = b.get(page)
            assert payload.decode() == ("" if head["WARC-Type"] == "revisit" else full[page])
    assert warc.bundle_pages(d.limit(0)).count() == 0
    small = {x["page_id"]: x["record_type"] for x in warc.bundle_pages(d, min_bytes=1).collect()}
    assert small[5] == "response" and small[3] == "revisit"


def test_chat(spark):
    call = {"content": "x", "tool_calls": [{"id": "a", "name": "f", "arguments": {"b": 1, "a": "s"}}, {"id": "b", "name": "f", "arguments": '{"a": 3}'}, {"id": "z", "name": "g", "arguments": "oops"}]}
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", json.dumps(call)), (1, 2, "user", "wait"), (1, 3, "tool", '{"tool_call_id":"a","content":"res é"}'), (1, 4, "tool", '{"tool_call_id":"q","content":"lost"}'), (1, 4, "tool", '{"tool_call_id":"q","content":"lost"}'), (None, None, None, None), (2, 0, "assistant", "{bad")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as c", "2 as id", "3 as chunk")
    at = chat.Format(tools=(chat.Tool("f", {"a": "string", "b": "integer"}, ("a",)),))
    got = {x["conv_id"]: x for x in chat.conversations(d, at).collect()}
    one = got[1]
    assert one["n_repeats"] == 1
    assert [one[k] for k in ("n_messages", "n_calls", "n_results", "n_linked", "n_unanswered", "n_invalid")] == [5, 3, 2, 1, 2, 2]
    m = json.loads(one["messages"])
    assert [x["content"] for x in m] == ["hi", "x", "res é", "wait", "lost"]  # the result directly behind its call
    assert m[1]["tool_calls"][0] == {"arguments": '{"a":"s","b":1}', "id": "a", "name": "f", "valid": True}
    assert json.loads(got[2]["messages"]) == [{"content": "{bad", "role": "assistant"}]
    assert json.loads(got[None]["messages"]) == [{"content": ""}]
    assert chat.conversations(d.limit(0)).count() == 0


def test_a_crowded_turn_is_cut_in_its_order(spark):
    calls = [{"id": f"c{i}", "name": "f", "arguments": {"n": i}} for i in range(40)]
    rows = [(1, 0, "assistant", json.dumps({"content": "do", "tool_calls": calls}))] + [(1, 3 + i, "tool", json.dumps({"tool_call_id": f"c{i}", "content": str(i)})) for i in range(40)]
    rows += [(2, 0, "user", f"{i:03d}") for i in range(500)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = chat.conversations(d, chat.Format(chunk=8)).orderBy("conv_id", "chunk", "part").collect()
    assert max(x["n_messages"] for x in out) == 32
    one = [m for x in out if x["conv_id"] == 1 for m in json.loads(x["messages"])]
    assert one[0]["content"] == "do" and [m["content"] for m in one[1:]] == [str(i) for i in range(40)] and all(m["linked"] for m in one[1:])
    assert [m["content"] for x in out if x["conv_id"] == 2 for m in json.loads(x["messages"])] == [f"{i:03d}" for i in range(500)]


def test_tools_that_call_tools(spark):
    call = lambda *ids, **more: json.dumps({"content": "+".join(ids), "tool_calls": [{"id": i, "name": "f", "arguments": {}} for i in ids], **more})
    rows = [(1, 5, "assistant", call("a")), (1, 6, "user", "u"), (1, 7, "tool", call("b", tool_call_id="a")), (1, 2, "tool", call("c", tool_call_id="b")), (1, 9, "tool", '{"tool_call_id":"c","content":"end"}')]
    rows += [(2, 1, "tool", call("x", tool_call_id="y")), (2, 2, "tool", call("y", tool_call_id="x")), (2, 3, "tool", '{"tool_call_id":"x","content":"hangs"}')]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x["conv_id"]: x for x in chat.conversations(d).collect()}
    assert [m["content"] for m in json.loads(got[1]["messages"])] == ["a", "b", "c", "end", "u"] and got[1]["n_linked"] == 3
    assert [m["content"] for m in json.loads(got[2]["messages"])] == ["x", "y", "hangs"] and got[2]["n_linked"] == 0


def test_schemas_are_inferred(spark):
    made = [{"q": "x", "n": i} if i % 2 else {"q": "y"} for i in range(200)] + [{"q": 3}, {"n": 1}, {"q": "z", "odd": 1}, {"q": "z", "n": 1.5}]
    rows = [(i, 0, "assistant", json.dumps({"content": "", "tool_calls": [{"id": "a", "name": "f", "arguments": a}, {"id": "b", "name": f"g{i % 3}", "arguments": "[]"}]})) for i, a in enumerate(made)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x["conv_id"]: [c["valid"] for c in json.loads(x["messages"])[0]["tool_calls"]] for x in chat.conversations(d).collect()}
    assert got == {i: [i < 200, False] for i in range(204)}


def test_conversations_equal_plain_ones(spark):
    r = random.Random(9)
    rows = []
    for i in range(700):
        conv, turn, ids = r.choice([None, 1, 2, 3]), r.choice([None, *range(60)]), [f"i{r.randrange(30)}" for _ in range(r.randrange(3))]
        role = r.choice(["user", "assistant", "tool", "tool", None])
        arguments = lambda: r.choice([{}, {"a": "x"}, {"a": 1}, {"a": "x", "b": 2}, {"b": 2.5, "a": "y"}, '{"a": "t"}', "bad", [1], None])  # noqa: B023, E731
        body = {"content": f"m{i}", **({"tool_call_id": f"i{r.randrange(30)}"} if r.random() < 0.7 else {}), **({"tool_calls": [{"id": x, "name": r.choice("fgh"), "arguments": arguments()} for x in ids]} if r.random() < 0.3 else {})}
        rows.append((conv, turn, role, json.dumps(body) if role in ("assistant", "tool") else r.choice(["hi", f"m{i}", None])))
    rows += rows[:20]
    tools = (chat.Tool("f", {"a": "string", "b": "number"}, ("a",)), chat.Tool("g", {"a": "integer"}, (), False))
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    out = chat.conversations(d, chat.Format(tools, chunk=8, crowd=3)).collect()
    got = {}
    for x in sorted(out, key=lambda x: (x["conv_id"] or 0, x["chunk"], x["part"])):
        got.setdefault((x["conv_id"], x["chunk"]), []).extend(json.loads(x["messages"]))
    want, counts = plain.chat(rows, tools, 8)
    assert got == want
    assert {k: sum(x[k] for x in out) for k in counts} == counts


def test_plain_conversations_are_whole(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f'say "{c}" \\ {t}\n') for c in range(5) for t in range(20)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.conversations(d, chat.Format(chunk=8)).orderBy("conv_id", "chunk").collect()
    assert [(m["role"], m["content"]) for x in out for m in json.loads(x["messages"])] == [(r, t) for _, _, r, t in rows]
