"""Text functions and rules against plain Python."""

import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from siftwell.functions import rules, text
from siftwell.operators import dedup, families, gates, labels, quality, turns
from siftwell.operators.components import connected_components
from siftwell.operators.store import cut, scratch
from siftwell.sources import jsonl, sinks

TEXTS = [
    None, "", "  ", "好的", "继续。", "ok", "A1.5", "abc_d-1", "Ｆｕｌｌ　ｗｉｄｔｈ text", "a b\x1cc", "贵州茅台 2026-08-03 涨了 5%？", "比较 $AAPL 和 $100 与 100元", "T0 Q1 v2 12,000.5 end",
    "2024年3月5日", "é日本a_b", "供你总结：", "x" * 2001, "你好啊abc", "价格 1 2 3", "1234", "5678", "İstanbul Straße", "a.b,c", "!!!", "短句", "您好,请按以下Step1,Step2,Step3步骤,完成“提交",
]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "row_ord long, text string")


def normal(t):
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", (t or "").replace("　", " "))).strip()


def slotted(t):
    t = normal(t)
    t = re.sub("|".join(map(re.escape, text.entity_names())), " <stock> ", t)
    cjk = "一-鿿"
    for p, s in (
        (r"\$[a-z][a-z0-9.\-]*", "ticker"), (r"(?:\$|us\$|hk\$|rmb|人民币|美元|港币|元)\s*\d[\d,]*(?:\.\d+)?", "num"), (r"\d[\d,]*(?:\.\d+)?\s*%", "num"),
        (r"\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{1,4}年\d{1,2}月(?:\d{1,2}日)?", "date"), (rf"(?<![0-9a-z{cjk}])\d[\d,]*(?:\.\d+)?(?![0-9a-z{cjk}])", "num"),
    ):
        t = re.sub(p, f" <{s}> ", t, flags=re.I)
    return re.sub(r"\s+", " ", t).strip()


def token_set(t):
    out = set()
    for w in slotted(t).lower().split():
        if w in text.SLOTS:
            out.add(w)
        else:
            out |= {x for sub in re.split(r"\W+", w) for x in re.split("([一-鿿])", sub) if x}
    return out


def test_normal_form_slots_and_tokens(spark):
    rows = frame(spark).select("text", text.normalize_question(F.col("text")).alias("n")).withColumn("s", text.slot_entities(F.col("n"))).withColumn("t", text.tokens(F.col("s"))).collect()
    for r in rows:
        assert r["n"] == normal(r["text"])
        assert r["s"] == slotted(r["text"]), r["text"]
        assert set(r["t"]) == token_set(r["text"]), r["text"]


def test_reject_reasons(spark):
    got = [r[0] for r in frame(spark).orderBy("row_ord").select(rules.reject_reason(text.normalize_question(F.col("text")))).collect()]
    by = dict(zip(TEXTS, got, strict=True))
    assert by[None] == by[""] == by["  "] == "blank" and by["好的"] == "low_value_common" and by["继续。"] == "context_only_followup"
    assert by["A1.5"] == "number_or_code_only" and by["abc_d-1"] == "ascii_token_only" and by["x" * 2001] == "too_long_gt2000" and by["短句"] == "too_short"
    assert by["供你总结："] == "embedded_page_or_prompt_context" and by["价格 1 2 3"] == "mostly_symbol_short" and by["贵州茅台 2026-08-03 涨了 5%？"] == ""
    assert by[TEXTS[-1]] == "submission_template_fragment"


def test_answer_reasons(spark):
    long = "一个完整的回答" * 10
    cases = [(long, "q", None, None), (long, "q", "runFailed", "last_event_type=runFailed"), (" ", "q", None, "empty_answer"), ("抱歉，我无法回答" + long, "q", None, "refusal"), ("短", "q", None, "answer_too_short(1<50)"), (long + "，", "q", None, "truncated_dangling_punctuation"), (long + "，", "", None, None), ("unable to answer " + long, "q", "runFinished", None)]
    df = spark.createDataFrame([(a, q, e, w) for a, q, e, w in cases], "a string, q string, e string, w string")
    assert all(r[0] == r[1] for r in df.select(rules.answer_reason(F.col("q"), F.col("a"), F.col("e")), "w").collect())


def test_times(spark):
    df = spark.createDataFrame([("2026-08-04 10:47:25", 1785811645000), ("2026-08-04T10:47:25+00:00", 1785840445000), ("20260804T104725", 1785811645000), ("2026-08-04", 1785772800000), ("x", None), (None, None)], "t string, w long")
    assert all(r[0] == r[1] for r in df.select(text.epoch_millis(F.col("t")), "w").collect())


def test_phrases_lengths_and_grounding(spark):
    df = spark.createDataFrame([("a b c d e f g h i", "“你好”，世界 1"), ("你好世界你好世界你", "")], "a string, b string")
    got = df.select(text.phrases(F.col("a")), text.length_without_signs(F.col("b")), text.grounded(F.array(F.lit("b c")), F.col("a")), text.cjk_ratio(F.col("a"))).collect()
    assert sorted(got[0][0]) == ["a b c d e f g h", "b c d e f g h i"] and got[0][1] == 5 and got[0][2] and got[0][3] == 0
    assert sorted(got[1][0]) == ["你好世界你好世界", "好世界你好世界你"] and not got[1][2] and got[1][3] == 1


def test_segments_are_repaired_and_topics_merged(spark):
    s = "array<struct<start:int,end:int,topic:string>>"
    cases = [([(0, 1, "a"), (2, 3, "b")], 4, [(0, 1, "a"), (2, 3, "b")]), ([(0, 1, "a"), (3, 4, "b")], 5, [(0, 1, "a"), (2, 4, "b")]), ([(0, 0, "a"), (5, 6, "b")], 7, None), ([(0, 0, "a"), (1, 1, "b"), (2, 3, "a")], 4, [(0, 3, "a")]), ([], 2, None),
        ([(0, 1, "a"), (1, 2, " b ")], 4, [(0, 1, "a"), (2, 3, "b")]), ([(0, 1, "a"), (0, 1, "b"), (2, 3, "c")], 4, [(0, 1, "a"), (2, 2, "b"), (3, 3, "c")]),
        ([(0, 4, "a")], 4, None), ([(-1, 3, "a")], 4, None), ([(0, 3, " ")], 4, None), ([(0, None, "a")], 1, None),
    ]
    df = spark.createDataFrame([(a, n) for a, n, _ in cases], f"s {s}, n int")
    got = [r[0] for r in df.select(turns.repaired_segments(F.col("s"), F.col("n"))).collect()]
    assert [None if g is None else [tuple(x) for x in g] for g in got] == [w for _, _, w in cases]


def test_prior_turns_of_few_rows_and_of_all(spark):
    rows = [(s, i, f"q{i}", f"a{i}") for s in (1, 2) for i in range(6)]
    t = turns.with_segments(spark.createDataFrame(rows, "session long, idx int, question string, answer string"), spark.createDataFrame([(1, 0, 2, "x"), (1, 3, 5, "y")], "session long, start int, end int, topic string"))
    all_ = {(r["session"], r["idx"]): [p["question"] for p in r["prior"]] for r in turns.with_prior(t).collect()}
    assert all_[1, 0] == [] and all_[1, 2] == ["q0", "q1"] and all_[1, 3] == ["q0", "q1", "q2"] and all_[1, 5] == ["q3", "q4"] and all_[2, 4] == ["q0", "q1", "q2", "q3"]
    few = turns.with_prior(t.where("idx > 3"), turns.asked_and_answered(t))
    assert {(r["session"], r["idx"]): [p["question"] for p in r["prior"]] for r in few.collect()} == {k: v for k, v in all_.items() if k[1] > 3}


def test_keep_first_and_numbering(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, ""), (5, None), (4, "b"), (6, "")], "o long, k string").repartition(3)
    assert sorted(r["o"] for r in turns.keep_first(df, F.col("k"), F.col("o")).collect()) == [1, 2, 4, 5, 6]
    assert sorted((r["o"], r["row_ord"]) for r in labels.numbered(df, "o").collect()) == [(i + 1, i) for i in range(6)]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 200), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), cut).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}, 200: 200}


def brute_clusters(texts, threshold=0.8):
    n = len(texts)
    sets = [token_set(t) for t in texts]
    words = [s - set(text.SLOTS) for s in sets]
    counts = [{s: slotted(t).lower().split().count(s) for s in text.SLOTS} for t in texts]
    size = [sum(not unicodedata.category(c).startswith(("P", "S", "Z")) for c in t or "") for t in texts]
    top = list(range(n))
    find = lambda x: x if top[x] == x else find(top[x])
    classes = {}
    for i in range(n):
        if len(words[i]) >= 4:
            classes.setdefault((frozenset(words[i]), tuple(counts[i].values())), []).append(i)
    compared = {i for i in range(n) if words[i]}
    for members in classes.values():
        if len(members) > 1:
            best = max(members, key=lambda i: (size[i], -i))
            compared -= set(members) - {best}
            for i in members[1:]:
                top[find(i)] = find(members[0])
    for i in sorted(compared):
        for j in sorted(compared):
            same = all(not counts[i][s] or not counts[j][s] or counts[i][s] == counts[j][s] for s in text.SLOTS)
            if i < j and same and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                top[find(j)] = find(i)
    for i in range(n):
        for j in range(i + 1, n):
            if not words[i] and not words[j] and normal(texts[i]) and normal(texts[i]) == normal(texts[j]):
                top[find(j)] = find(i)
    groups = {}
    for i in range(n):
        groups.setdefault(find(i), []).append(i)
    return {i: max(g, key=lambda x: (size[x], -x)) for g in groups.values() for i in g}


def test_lexical_clusters_match_brute_force(spark):
    draw = random.Random(3)
    base = ["请帮我分析一下贵州茅台最近的走势和风险", "compare the profit of $AAPL and $MSFT over the last 5 years in detail", "列出2024年3月以来涨幅超过10%的股票并说明原因"]
    texts = [None, "", " ", "1234", "5678", "1234 ", *base, *[b.replace("贵州茅台", "五粮液").replace("$AAPL", "$TSLA").replace("10%", "20%") for b in base], "比较贵州茅台和五粮液的走势如何", "比较贵州茅台、五粮液和泸州老窖的走势如何"]
    for _ in range(40):
        w = draw.choice(base).split(" ") if draw.random() < 0.5 else list(draw.choice(base))
        w[draw.randrange(len(w))] = draw.choice(["新", "word", "的"])
        texts.append(" ".join(w) if "compare" in " ".join(w) else "".join(w))
    got = {r["row_ord"]: r for r in dedup.lexical_clusters(frame(spark, texts)).collect()}
    assert {i: r["representative"] for i, r in got.items()} == brute_clusters(texts)
    assert all(r["kept"] == (r["method"] is None) for r in got.values())


def test_stars_match_the_greedy_order(spark):
    draw = random.Random(5)
    for _ in range(3):
        n = 25
        rank = draw.sample(range(100), n)
        protected = [draw.random() < 0.1 for _ in range(n)]
        pairs = [(i, j) for i in range(n) for j in range(i + 1, n) if draw.random() < 0.15]
        linked = {frozenset(p) for p in pairs}
        reps, want = [], {}
        for i in sorted(range(n), key=lambda i: rank[i]):
            hit = [] if protected[i] else [r for r in reps if frozenset((i, r)) in linked]
            want[i] = min(hit, key=lambda r: rank[r]) if hit else i
            if not hit:
                reps.append(i)
        rows = spark.createDataFrame([(i, rank[i], protected[i]) for i in range(n)], "row_ord long, rank long, protected boolean")
        got = {r[0]: r[1] for r in families.star_clusters(rows, spark.createDataFrame(pairs, "a long, b long")).collect()}
        assert got == want


def test_equal_texts_have_one_normal_form(spark):
    got = {r[0]: r[1] for r in dedup.exact_text_groups(frame(spark, ["ＡＢ  c", "AB c", " ", None, "AB　c", "ab c"])).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 0, 5: 5}


def test_chain_gates(spark):
    step = "array<struct<plan:string,tools:array<struct<name:string,input:string,output:string>>>>"
    rows = [([("p", [("a", "", ""), ("b", "", "")]), ("q", [("a", "", "")])], 9, "x"), ([], 8, "x, y,,x"), ([], None, None), ([("p", None)], 3, "z")]
    df = spark.createDataFrame(rows, f"c {step}, n long, t string")
    got = df.select(gates.chain_calls(F.col("c"), F.col("n")), gates.chain_steps(F.col("c"), F.col("n")), F.size(gates.chain_tools(F.col("c"), F.col("t")))).collect()
    assert [tuple(r) for r in got] == [(3, 2, 2), (8, 1, 2), (0, 0, 0), (0, 1, 1)]


def test_lines_and_rejects(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1}\n\n[1]\n{"a":1} x\n{"a":1,"a":2,"b":NaN}\nplain\n', encoding="utf-8")
    good, bad = jsonl.read_records(spark, str(tmp_path))
    assert sorted((r["line_number"], r["json"]) for r in good.collect()) == [(1, '{"a":1}'), (5, '{"a":2,"b":null}')]
    assert sorted((r["line_number"], r["reason"]) for r in bad.collect()) == [(3, "not_an_object"), (4, "invalid_json"), (6, "invalid_json")]
    assert jsonl.first_lines(spark, str(tmp_path), 3) == ['{"a":1}', "[1]", '{"a":1} x']
    with pytest.raises(Exception, match="in line [346] of"):
        jsonl.read_strict(spark, str(tmp_path), "a long").collect()
    assert jsonl.parsed('{"a":1e999,"b":"\\ud800"}') == ("", '{"a":null,"b":"?"}')


def test_lines_are_numbered_over_many_splits(spark, tmp_path):
    lines = ["" if i % 7 == 3 else "{" if i % 11 == 5 else json.dumps({"i": i + 1}) for i in range(3000)]
    for name in "ab":
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        strict = [r["line_number"] for r in jsonl.read_records(spark, str(tmp_path))[1].collect()]
        got = [(r["file"][-7:], r["line_number"], json.loads(r["json"])["i"]) for r in jsonl.read_records(spark, str(tmp_path))[0].collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    good = [i + 1 for i in range(3000) if i % 7 != 3 and i % 11 != 5]
    assert sorted(got) == [(f"{n}.jsonl", i, i) for n in "ab" for i in good]
    assert sorted(strict) == sorted(2 * [i + 1 for i in range(3000) if i % 11 == 5 and i % 7 != 3])


def test_a_deliverable_is_there_whenever_a_write_dies(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/out"
    rows = lambda *x: spark.createDataFrame([(i, v) for i, v in enumerate(x)], "row_ord long, v string")
    read = lambda: [json.loads(r["value"])["v"] for r in spark.read.text(path).collect()]
    jsonl.write_lines(rows("b", "a"), path, single=True)
    rename, calls = jsonl._rename, []

    def dies(*x):
        calls.append(x)
        if len(calls) == 2:  # the old folder is aside, the new one has not taken its place
            raise RuntimeError
        rename(*x)

    monkeypatch.setattr(jsonl, "_rename", dies)
    with pytest.raises(RuntimeError):
        jsonl.write_lines(rows("c"), path)
    monkeypatch.undo()
    assert not (tmp_path / "out").exists()
    jsonl.settle(spark, path)
    assert read() == ["b", "a"]
    jsonl.write_lines(rows("c"), path)
    assert read() == ["c"] and [x.name for x in tmp_path.iterdir() if not x.name.startswith(".")] == ["out"]


def test_the_stream_gates_as_the_batch_does(spark, tmp_path):
    from siftwell.streaming.gate import gated, stream_gate

    long = "一个完整的回答" * 10
    rows = [("ＯＫ", long), ("请分析一下这个行业的走势", long), ("请分析一下这个行业的走势", long), ("好的", long), ("ｆｏｏ＿ｂａｒ", long), ("请分析一下这家公司的风险", "短")]
    df = spark.createDataFrame([(q, a, "hard") for q, a in rows], "question string, answer string, difficulty_level string")
    assert [r["reason"] for r in gated(df).collect()] == ["low_value_common", "", "", "low_value_common", "ascii_token_only", "answer_too_short(1<50)"]
    df.repartition(3).write.json(f"{tmp_path}/in")
    for _ in range(2):  # the second finds nothing new
        stream_gate(spark, f"{tmp_path}/in", df.schema.simpleString()[7:-1].replace(":", " "), f"{tmp_path}/log", f"{tmp_path}/state", files_per_batch=1).awaitTermination()
        assert [sinks.LineLog(spark, f"{tmp_path}/log").read(s).count() for s in sinks.STREAMS] == [1, 1, 0]
        df.limit(2).write.mode("append").json(f"{tmp_path}/in")


def test_a_log_takes_each_line_once_and_output_is_canonical(spark, tmp_path):
    rows = spark.createDataFrame([("hard", "a b", None), ("normal", "c", 1), ("other", "d", 2), ("hard", "a b", None)], "difficulty_level string, t string, n int")
    log = sinks.LineLog(spark, scratch(spark))
    log.append(rows)
    log.append(rows)
    assert [log.read(s).count() for s in sinks.STREAMS] == [3, 1, 1]
    log.check()
    assert '{"difficulty_level":"hard","t":"a b","n":null}' in {r["line"] for r in log.read("complex").collect()}
    assert sinks.valid_batch_id("20260804T104725+0800_ab12") and len(quality.sample_indices(50, 0.05, 42)) == 2
