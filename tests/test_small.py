"""Settings, reports, taxonomy, family verdicts and quality overviews."""

import json
import random

import pytest
from pyspark.sql import functions as F

from siftwell.operators import families, labels, quality
from siftwell.operators.grounding import quoted
from siftwell.operators.store import scratch
from siftwell.plans import config, report


def test_settings_from_files(tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"dialect": "chat", "gate": {"calls": 5}, "label_path": "labels", "stages": ["precheck"]}))
    s = config.load(str(path))
    assert s.gate.calls == 5 and s.label_path == f"{tmp_path}/labels" and s.stages == ("precheck",)
    for bad in ({"nothing": 1}, {"threshold": 1.5}, {"verify_rounds": -1}, {"max_candidates": 0}, {"candidate_threshold": -0.1}, {"dedup_mode": "x"}):
        with pytest.raises(ValueError):
            config.from_dict(bad)


def test_a_session_is_known_by_its_content(spark):
    from siftwell.operators.turns import session_content_key
    from siftwell.sources import dialects

    said = lambda *questions, key="a", **more: {"thread_id": key, "context": [{"question": q, "answer": "x", **more} for q in questions]}
    rows = [said("ab", "c"), said("ab", "c"), said("a", "bc"), said("ab", "c", key="b"), said("ab", "c", status="failed"), said("ab", "c", chain=[{"plan": "p", "tools": []}])]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "row_ord long, json string")
    sessions, _ = dialects.adapt(df, "session")
    keys = [r[0] for r in sessions.orderBy("row_ord").select(session_content_key(F.col("session_key"), F.col("mode"), F.col("turns"))).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 5


def test_taxonomy_lines():
    rows = quality.parse_taxonomy(["01  complex-topic/01-x  A name", "", "01-y  Another"])
    assert rows == [("hard", "01", "complex-topic/01-x", "A name"), ("normal", "01", "01-y", "Another")]
    for bad in (["what"], ["01-y a", "01-z b"]):
        with pytest.raises(ValueError):
            quality.parse_taxonomy(bad)
    assert quality.missing_and_extra(["a", "c"], ["a", "b"]) == (["b"], ["c"])


def test_family_verdicts_match_their_order(spark):
    def greedy(groups, rank):
        """What the families do one after the other."""
        removed, action = set(), {}
        for members, label, confidence in groups:
            if label and confidence != "low" and label == "eval_template_family":
                removed |= set(members)
                action |= dict.fromkeys(members, ("eval_template", None))
        for members, label, confidence in sorted(groups, key=lambda g: (g[0][0], -len(g[0]))):
            active = [m for m in members if m not in removed]
            if label == "semantic_duplicate" and confidence != "low" and len(active) > 1:
                best = min(active, key=lambda m: rank[m])
                action |= {m: ("semantic_duplicate", best) for m in active if m != best}
                removed |= set(active) - {best}
        for members, label, confidence in groups:
            for m in members:
                if label and m not in removed:
                    new = "force_normal" if confidence == "low" else "protect" if label == "natural_shared_phrase" else "keep"
                    order = ("force_normal", "protect", "keep")
                    old = action.get(m, ("keep", None))[0]
                    action[m] = (min(old, new, key=order.index), None)
        return action

    draw = random.Random(4)
    labels = ["eval_template_family", "semantic_duplicate", "semantic_duplicate", "semantic_duplicate", "natural_shared_phrase", None]
    for k in range(2):
        rank = dict(enumerate(draw.sample(range(100), 30)))
        groups = [(sorted(draw.sample(range(30), draw.randint(3, 8))), draw.choice(labels), draw.choice(["low", "high", "high"])) for _ in range(9)]
        groups = list({(g[0][0], len(g[0])): g for g in groups}.values())  # no ties of the order
        families_ = spark.createDataFrame([(i, m[0], len(m), lab, c if lab else None) for i, (m, lab, c) in enumerate(groups)], "family long, first long, n_rows long, label string, confidence string")
        members = spark.createDataFrame([(i, m) for i, g in enumerate(groups) for m in g[0]], "family long, row_ord long")
        ranks = spark.createDataFrame(list(rank.items()), "row_ord long, rank long")
        got = {r["row_ord"]: (r["action"], r["representative"]) for r in families.family_actions(families_, members, ranks).collect()}
        assert got == greedy(groups, rank), k


def test_candidates_are_each_rows_most_similar_ones(spark):
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(14)]
    sets = [tuple(sorted(draw.sample(vocabulary, draw.randint(3, 6)))) for _ in range(12)]
    tokens = [draw.choice(sets) for _ in range(40)] + [sets[0]] * 30 + [tuple(sorted([*sets[0], "x"]))] * 5  # one class is larger than the list
    rank = draw.sample(range(1000), len(tokens))
    n = len(tokens)
    jaccard = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    frequency = {t: sum(t in x for x in tokens) for x in tokens for t in x}
    want = {}
    for i in range(n):
        anchors = sorted((t for t in tokens[i] if frequency[t] > 1), key=lambda t: (frequency[t], t))[:8]
        pool = [j for j in range(n) if j != i and set(anchors) & set(tokens[j])]
        pool = sorted(pool, key=lambda j: (-jaccard(tokens[i], tokens[j]), rank[j]))[:20]
        want |= {(min(i, j), max(i, j)): jaccard(tokens[i], tokens[j]) for j in pool if jaccard(tokens[i], tokens[j]) >= 0.6}
    keys = [f"{t}{i % 2}" for i, t in enumerate(tokens)]
    for key in set(keys):
        members = [i for i in range(n) if keys[i] == key]
        best = min(members, key=lambda i: rank[i])
        want |= {(min(i, best), max(i, best)): 1.0 for i in members if i != best}
    rows = spark.createDataFrame([(i, list(tokens[i]), (keys[i],), rank[i]) for i in range(n)], "row_ord long, tokens array<string>, signature struct<k:string>, rank long")
    got = {(r["a"], r["b"]): r["similarity"] for r in families.signature_candidates(rows).collect()}
    assert got == want


def test_a_family_payload_shows_the_best_and_the_ends(spark):
    rows = spark.createDataFrame([(i, (i * 7) % 40, f"question {i} with the same long phrase of words in it today") for i in range(40)], "row_ord long, rank long, text string")
    found, members = families.phrase_families(rows.select("row_ord", "text"))
    said = [json.loads(r["payload"]) for r in families.family_payloads(found, members, rows).collect()]
    assert len(said) == 1 and said[0]["member_count"] == 40 and said[0]["shared_phrases"][0] == "same long phrase of words in it today"
    shown = [int(q.split()[1]) for q in said[0]["questions"]]
    ranked = sorted(range(40), key=lambda i: (i * 7) % 40)
    assert shown == list(dict.fromkeys([*ranked[:8], 0, 1, 38, 39]))


def test_quotes_match_brute_force(spark):
    draw = random.Random(2)
    passages = [(i, "".join(draw.choice("ab，") for _ in range(draw.randint(1, 4)))) for i in range(12)] + [(20, ""), (21, None)]
    texts = [(i, "".join(draw.choice("ab, ") for _ in range(30))) for i in range(30)] + [(50, None), (51, "")]
    form = lambda t: "".join((t or "").replace("，", ",").split())
    want = sorted((i, k) for i, t in texts for k, p in passages if form(p) in form(t))
    frames = spark.createDataFrame(texts, "row_ord long, text string"), spark.createDataFrame(passages, "passage long, text string")
    for size in (1 << 20, 10):
        assert sorted(map(tuple, quoted(*frames, size).collect())) == want


def test_calls_are_tried_again_only_where_that_helps():
    waits, calls = [], []

    def complete(system, user, answers):
        calls.append(user)
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    good = labels.retried(lambda s, u: complete(s, u, script), sleep=waits.append)
    script = [labels.Refused(429), labels.Refused(500), OSError(), "", "ok"]
    assert good("s", "u") == "ok" and len(waits) == 4 and all(1.5 * 2**k <= w <= 1.5 * 2**k + 0.5 for k, w in enumerate(waits))
    script = [labels.Refused(400), "ok"]
    with pytest.raises(labels.Refused):
        good("s", "u")
    script = [OSError()] * 9
    with pytest.raises(RuntimeError):
        good("s", "u")
    script = ["no", "{}", labels.Refused(400)]
    asked = labels.prompted(lambda s, u: complete(s, u, script), "p", lambda a: a.startswith("{"), tries=2)
    assert list(asked([("k1", "a"), ("k2", "b")])) == [("k1", "{}"), ("k2", None)]


def test_batches_are_whole_or_fail():
    def complete(system, user):
        items = json.loads(user)["pairs"]
        drop = [x for x in items if x["q"] != "missing"]
        if any(x["q"] == "broken" for x in items):
            return "no json"
        extra = [{"id": "stranger", "label": "x"}] if any(x["q"] == "strange" for x in items) else []
        return json.dumps({"items": [{"id": x["id"], "label": x["q"]} for x in drop] + extra})

    pairs = [(str(i), json.dumps({"q": q})) for i, q in enumerate(["a", "b", "missing", "c", "broken", "d", "strange", "e"])]
    got = dict(labels.batched(complete, "p", "pairs", "id", 2, lenient=True)(iter(pairs)))
    assert {k: v and json.loads(v)["label"] for k, v in got.items()} == {"0": "a", "1": "b", "2": None, "3": "c", "4": None, "5": None, "6": None, "7": None}
    assert dict(labels.batched(complete, "p", "pairs", "id", 2)(iter(pairs)))["3"] is None


def test_labels_are_kept_by_generation_and_compacted(spark):
    asked = spark.createDataFrame([("k1", "1"), ("k2", "2"), ("k2", "2"), ("k3", "3")], "key string, payload string")
    seen = []

    def stub(answer):
        return lambda pairs: ((k, answer if p != "3" else None) for k, p in pairs)

    path, valid = scratch(spark), F.col("label").isin("x", "y")
    get = lambda t, a: sorted((r["key"], r["label"]) for r in labels.labelled(asked, t, "s", stub(a), valid).collect())
    one = labels.LabelTable(spark, path, "1")
    assert get(one, "bad") == [("k1", None), ("k2", None), ("k2", None), ("k3", None)]
    want = [("k1", "x"), ("k2", "x"), ("k2", "x"), ("k3", None)]
    assert get(one, "x") == want == get(one, "y")
    two = labels.LabelTable(spark, path, "2")
    assert get(two, "y")[0] == ("k1", "y") and not seen
    small = one.compacted(scratch(spark))
    assert spark.read.parquet(small.path).count() == 2 and small.read("s").count() == 2 and get(small, "y") == want


def test_overview_and_report(spark):
    rows = spark.createDataFrame([(0, "a", "x", "pass", [("r", True)]), (1, "b", "x", "fail", [("r", False)]), (2, "b", "y", "needs_review", [("r", True)])], "row_ord long, id string, category string, status string, rules array<struct<rule:string,ok:boolean>>")
    o = quality.overview(rows, "d", "2026-01-01")
    assert o["status_counts"] == {"pass": 1, "fail": 1, "needs_review": 1} and o["rule_hits"] == [{"rule": "r", "passed": 2, "failed": 1}]
    assert [r["id"] for r in o["flagged"]] == ["b", "b"] and quality.record_detail(rows, "b")["row_ord"] == 1
    assert "| b | fail | r |" in report.quality(o) and report.suggestions([]).startswith("| min_calls")
    with pytest.raises(KeyError):
        quality.record_detail(rows, "z")
    keys = rows.select(quality.record_key(F.lit("c"), F.when(F.col("row_ord") > 0, F.col("id")), F.col("row_ord"))).collect()
    assert [k[0] for k in keys] == ["line_0", "c|b#1", "c|b#2"]
