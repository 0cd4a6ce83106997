"""Operators against plain versions and hand-written cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gristmill.functions import lang, parse, rewards, text, tools, validators, verify
from gristmill.operators import chunks, conversations, curate, dashboard, exports, generate, mining, rollouts
from gristmill.operators.components import connected_components
from gristmill.sources import config, readers, sinks
from gristmill.streaming import streams


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'double' if isinstance(v, float) else 'boolean' if isinstance(v, bool) else 'bigint' if isinstance(v, int) else 'array<string>'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_components_of_chains_and_trees(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    tree = [(1000 + i, 1000 + rng.randrange(i)) for i in range(1, 80)]
    odd = [(5000, 5000), (None, 9007), (6000, 6001), (6001, 6000)]
    df = spark.createDataFrame(chain + tree + odd, "src bigint, dst bigint").withColumn("component", F.lit("x"))
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert {got[i] for i in range(61)} == {0}
    assert {got[1000 + i] for i in range(80)} == {1000}
    assert got[5000] == 5000 and got[6001] == 6000 and 9007 not in got
    assert connected_components(df.limit(0)).count() == 0


def test_split_groups_hold_together(spark):
    rows = spark.createDataFrame([(1, "a", "q1"), (2, "b", "q1"), (3, "b", "q2"), (4, "c", "q3")], "id int, d string, q string")
    got = {r["id"]: (r["split_group"], r["split"]) for r in curate.split_groups(rows, F.col("d"), F.col("q")).collect()}
    assert got[1] == got[2] == got[3] and got[1][0] == "document:a" and got[4][0] == "document:c"


def test_decontamination_and_pruning(spark):
    index = curate.eval_shingles(spark.createDataFrame([("one two three four five six",)], "text string"))
    rows = spark.createDataFrame([(1, "One, two three four FIVE six!", "x"), (2, "", None), (3, "short", "one two three four five six")], "id int, query string, positive string")
    got = {r["id"]: (r["hit_field"], r["hit_share"]) for r in curate.decontaminated(rows, index, "id", ["query", "positive"]).collect()}
    assert got == {1: ("query", 1.0), 2: (None, None), 3: ("positive", 1.0)}
    n = spark.createDataFrame([(1, ["fine words here", "one two three four five six"], ["a", "b"])], "id int, negatives array<string>, negative_types array<string>")
    r = curate.pruned_negatives(n, index, "id", target=2).first()
    assert (r["negatives"], r["negative_types"], r["negatives_pruned"], r["below_target"]) == (["fine words here"], ["a"], 1, True)


def test_negatives(spark):
    assert one(spark, curate.cleaned_negatives(F.col("n"), F.lit("Q"), F.lit("P"), 2), n=[" q ", "p", "x  y", "X y", "", "z", "w"]) == ["x y", "z"]


def test_rollout_statistics_with_nulls_and_ties(spark):
    rows = [("g", 1, 0, "completed", 1.0, True), ("g", 2, 1, "failed", 1.0, True), ("g", 3, 2, "error", None, False), ("s", 4, 0, "timeout", 0.5, None)]
    df = spark.createDataFrame(rows, "group_id string, rollout_id int, rollout_index int, status string, reward double, success boolean")
    assert {r["group_id"]: r["best_rollout_id"] for r in rollouts.best_of(df).collect()} == {"g": 1, "s": 4}
    s = {r["group_id"]: r["reward_std"] for r in rollouts.reward_stats(df).collect()}
    assert s == {"g": 0.0, "s": 0.0}
    assert rollouts.reward_stats(df.limit(0)).count() == 0
    assert rollouts.run_summary(df.limit(0).select(F.lit(True).alias("accepted"), F.lit(False).alias("errored"), "reward")).first()["acceptance_rate"] == 0.0


@pytest.mark.parametrize(
    ("name", "params", "good", "bad"),
    [
        ("validate_lowercase", {}, "abc ß 1", "aBc"),
        ("validate_no_commas", {}, "a b", "a, b"),
        ("validate_quotation", {}, ' "x" ', '"x'),
        ("verify_paragraph_count", {"N": 2}, "a *** b *** ", "a"),
        ("validate_paragraphs", {"N": 2}, "a\n\nb", "a\nb"),
        ("validate_highlighted_sections", {"N": 1}, "a *b* c", "a b"),
        ("verify_keyword_frequency", {"word": "Ab", "N": 2}, "ab xAB", "ab"),
        ("verify_letter_frequency", {"letter": "a", "N": 2, "quantifier": "at most"}, "aAb", "aaa"),
        ("validate_frequency_capital_words", {"N": 1}, "AB cd X1", "AB CD"),
        ("validate_json_format", {}, "```json\n[1, NaN]\n```", "{x}"),
        ("validate_repeat_prompt", {"original_prompt": " hi "}, "hi there", "there hi"),
        ("validate_postscript", {"postscript_marker": "P.S."}, "a\nb\nP.S. c", "P.S. a\nb\nc\nd"),
        ("validate_forbidden_words", {"forbidden_words": ["No"]}, "yes", "noble"),
        ("validate_end_checker", {"end_phrase": "end."}, "the end. ", "the end"),
        ("validate_word_constraint", {"word": "CAT"}, "a cat", "a dog"),
        ("validate_number_of_words", {"N": 2}, " a  b ", "a"),
        ("validate_sections", {"N": 2, "section_splitter": "§"}, "a§b§ ", "a b"),
        ("validate_choice", {"options": ["yes", "no"]}, " yes ", "yess"),
        ("validate_placeholders", {"N": 1}, "[name]", "[]"),
        ("validate_title", {}, "a\n  # T", "a # T"),
        ("validate_two_responses", {}, "a\n\nb", "a"),
        ("verify_bullet_points", {"N": 2}, "- a\n * b", "-a\n- b"),
        ("verify_keywords", {"forbidden_words": ["a", "b"]}, "A b", "a"),
    ],
)
def test_validators(spark, name, params, good, bad):
    test = validators.VALIDATORS[name]
    assert one(spark, test(F.col("t"), **params), t=good) is True
    assert one(spark, test(F.col("t"), **params), t=bad) is False
    if "N" in params:
        assert one(spark, test(F.col("t")), t=bad) is True


def test_parsers(spark):
    t = "<python> a </python><python>b</python>"
    assert one(spark, parse.python_blocks(F.col("t")), t=t) == ["a", "b"]
    assert one(spark, parse.python_blocks(F.col("t")), t="```python\nx\n```") == ["x"]
    assert [tuple(r) for r in one(spark, parse.code_blocks(F.col("t")), t="```sh\nls\n``` ```py\nx\n```")] == [("bash", "ls"), ("python", "x")]
    assert one(spark, parse.final_answer(F.col("t")), t="none") is None
    assert one(spark, parse.boxed_answers(F.col("t")), t="\\boxed{10} \\boxed{a{b}c}") == ["10", "a{b}c"]
    assert one(spark, parse.invents_system_tags(F.col("t")), t="x</think>") is True
    assert one(spark, parse.without_system_tags(F.col("t")), t="a<repl>b</repl><think>c</think>d</think>") == "ad"
    for s, want in (("<think>x</think><tool_call>", True), ("<think><tool_call></think>", False), ("<think></think>", True), ("x", False)):
        assert one(spark, parse.thinks_then_calls(F.col("t")), t=s) is want
    assert one(spark, parse.chat_answer(F.col("t")), t="so Final Answer: 42") == "42"
    assert one(spark, parse.json_path(F.col("t"), "a.b[0].c"), t='{"a": {"b": [{"c": 5}]}}') == "5"
    assert one(spark, parse.fenced_json(F.col("t")), t='say {"a": 1} ok') == '{"a": 1}'


def test_tool_calls_are_bags(spark):
    a = '<tool_call>{"name": "f", "arguments": {"x": 1.0, "y": true}}</tool_call><tool_call>bad</tool_call><tool_call>[{"name": "g", "arguments": "{\\"k\\": 2}"}]</tool_call>'
    b = json.dumps([{"name": "g", "arguments": {"k": 2}}, {"name": "f", "arguments": {"y": 1, "x": 1}}])
    df = spark.createDataFrame([(a, b), (a, "[]"), (None, None)], "a string, b string")
    got = [r["x"] for r in df.select(parse.calls_match(parse.tool_calls("a"), parse.native_tool_calls("b")).alias("x")).collect()]
    assert got == [True, False, True]


def test_language(spark):
    deva, latn = lang.language("ne-Deva"), lang.language("ne-Latn")
    assert one(spark, lang.language_issue(F.col("t"), deva), t="नेपाल राम्रो छ") is None
    assert one(spark, lang.language_issue(F.col("t"), deva), t="abc") == "insufficient_script_ratio:ne-Deva:0.000"
    assert one(spark, lang.language_issue(F.col("t"), latn), t="छ yo ho") == "forbidden_script:ne-Latn"
    assert one(spark, lang.language_issue(F.col("t"), latn), t="yo ramro ho") is None
    assert one(spark, lang.language_issue(F.col("t"), latn), t="  ") == "empty_text"
    with pytest.raises(ValueError):
        lang.language("xx")
    assert one(spark, lang.numbers(F.col("t")), t="१,२३४ and \\boxed{5.5}") == [5.5]
    assert one(spark, lang.has_token(F.col("t"), F.lit("cat")), t="concat") is False
    assert one(spark, lang.protected_score(F.col("a"), F.col("b")), a="5 kg and `x`", b="`x`") == pytest.approx(0.5)


def test_verifiers(spark):
    for a, b, want in (("\\frac{1}{2}", "0.5", True), ("2^10", "1024", True), ("\\sqrt{2}", "1.41421356", True), ("x + 1", "x+1", True), ("__import__('os')", "1", False), ("9**9**9", "1", False)):
        assert one(spark, verify.math_match(F.col("a"), F.col("b")), a=a, b=b) is want
    assert one(spark, verify.equal_answer(F.lit(None).cast("string"), F.array(F.lit("x")))) is None
    assert one(spark, verify.average_precision(F.array(F.lit(True), F.lit(False), F.lit(True)))) == pytest.approx(5 / 6)
    v = F.array(F.struct(F.lit(0).alias("context_index"), F.lit(True).alias("relevant")), F.struct(F.lit(0).alias("context_index"), F.lit(True).alias("relevant")))
    assert one(spark, verify.context_precision(v, F.lit(2))["problem"]) == "verdicts don't match contexts"
    assert one(spark, verify.option_match(F.lit("b"), F.lit("answer: (b)"))) is True
    assert one(spark, verify.judge_average(F.array(F.lit(None).cast("double")))) is None


def test_termination_order(spark):
    t = rewards.termination(F.lit(3), F.lit(5), F.lit(9), F.lit(0), F.lit(0))
    assert tuple(one(spark, t)) == (True, "Format violation: 3/3")
    assert tuple(one(spark, rewards.termination(F.lit(0), F.lit(0), F.lit(0), F.lit(4), F.lit(0), max_turns=5)))[0] is True
    with pytest.raises(ValueError):
        rewards.reward("Simple")(lambda m: m)


def test_conversation_fold(spark):
    turns = [("user", "a"), ("assistant", "b"), ("user", "[System] fix"), ("assistant", "c")]
    row = F.array(*(F.struct(F.lit(r).alias("role"), F.lit(c).alias("content"), F.lit("why" if c == "c" else None).cast("string").alias("reasoning")) for r, c in turns))
    got = one(spark, conversations.built(row, F.lit("s")))
    assert [(m["from"], m["value"]) for m in got] == [("system", "s"), ("human", "a"), ("gpt", "<think>\nwhy\n</think>\n\nc")]
    twice = F.array(*(F.struct(F.lit("user").alias("role"), F.lit(c).alias("content"), F.lit(None).cast("string").alias("reasoning")) for c in "ab"))
    assert one(spark, conversations.built(twice, F.lit("s"))) is None


def test_chunks_cover_the_text(spark):
    t = " ".join(f"word{i}" for i in range(500))
    parts = chunks.windows(t, 200, 20)
    assert parts[0][0] == 0 and parts[-1][1] == len(t) and all(b - a <= 200 for a, b in parts) and all(n[0] <= p[1] for p, n in zip(parts, parts[1:]))
    df = spark.createDataFrame([(1, [(1, "aaa bbb"), (2, "ccc")]), (2, None)], "id int, pages array<struct<page:int,text:string>>")
    assert [(r["first_page"], r["last_page"], r["text"]) for r in chunks.chunked_pages(df, "id", "pages", 100, 10).collect()] == [(1, 2, "aaa bbb\n\nccc")]
    with pytest.raises(ValueError):
        chunks.chunked(df, "id", "pages", 10, 10)


def test_text(spark):
    assert one(spark, text.normalize_key(F.col("t")), t=" Straße  é ") == "strasse é"
    assert one(spark, text.document_date(F.col("t")), t="साल २०७२ and 1999-01-02") == "1999-01-02"
    assert one(spark, text.slug(F.col("t")), t="__A b!c__") == "A_b_c"
    w = text.shingles(F.col("w"), 3)
    assert one(spark, w, w=["a", "b"]) == ["a b"] and one(spark, w, w=[]) == []
    rows = [one(spark, text.split_for(F.lit(f"g{i}"))) for i in range(30)]
    assert {"train"} <= set(rows) <= {"train", "validation", "test"}


def test_generation_keeps_rows(spark):
    tasks = spark.createDataFrame([("a", "ok one"), ("b", "bad")], "id string, q string")
    rows = generate.rollout_rows(tasks, 2)
    got = generate.generated(rows, lambda: generate.Scripted({"bad": ValueError("no"), "one": "1"}), F.col("q")).collect()
    assert len(got) == 4 and {r["output_error"] for r in got if r["id"] == "b"} == {"ValueError: no"} and {r["output"] for r in got if r["id"] == "a"} == {"1"}
    judged = generate.judged(tasks, {"x": lambda: generate.Scripted({}, '{"score": 7}'), "y": lambda: generate.Scripted({"bad": ValueError()}, "8 of 10")}, F.col("q"))
    assert {r["id"]: r["score"] for r in judged.collect()} == {"a": 7.5, "b": 7.0}


def test_sources(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": 1, "t": "x"}\n\n{"id": 2}\n')
    assert readers.read(spark, str(p), "id int, t string").count() == 2
    p.write_text('{"id": 1}\nnot json\n')
    assert readers.json_lines(spark, str(p), "id int", strict=False).count() == 1
    with pytest.raises(Exception):
        readers.json_lines(spark, str(p), "id int").collect()
    j = tmp_path / "b.json"
    for body, n in (('[{"id": 1}, {"id": 2}]', 2), ('{"rows": [{"id": 1}]}', 1), ('{"id": 3}', 1)):
        j.write_text(body)
        assert readers.read(spark, str(j), "id int").count() == n
    with pytest.raises(ValueError):
        readers.read(spark, "x.csv")
    assert readers.paged(spark, "gristmill.sources.readers:numbered_rows", 205, "id long, text string").count() == 205
    assert config.overlay(config.Curation(), {"chunk_size": 500}).chunk_size == 500
    for wrong in ({"chunk_overlap": 5000}, {"train": 0.95, "validation": 0.1}, {"nothing": 1}):
        with pytest.raises(ValueError):
            config.overlay(config.Curation(), wrong)
    with pytest.raises(ValueError):
        config.export_paths("/x", "../y")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0)], "id string, reward double")
    path = str(tmp_path / "out")
    assert sinks.append_new(rows, path) == 2 and sinks.append_new(rows, path) == 0
    assert sinks.append_new(spark.createDataFrame([("c", 3.0), ("a", 1.0)], rows.schema), path) == 1
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "id string, t int, v string")
    new = spark.createDataFrame([("a", 2, None), ("c", 1, "z"), ("a", 3, "w")], old.schema)
    assert {r["id"]: (r["t"], r["v"]) for r in sinks.upserted(old, new, "id", "t").collect()} == {"a": (3, "w"), "b": (1, "y"), "c": (1, "z")}
    r = sinks.export_records(spark.createDataFrame([("a", ["m", "n"], 1.0), ("b", None, None), ("c", ["m"], 0.0)], "id string, conversation array<string>, reward double"))
    sinks.write_export(r, config.export_paths(str(tmp_path), "run"))
    assert spark.read.json(str(tmp_path / "run_summary")).first()["errors"] == 1
    sinks.write_split(rows, F.col("id") == "a", str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s.dropped")).count() == 1
    assert "n<1K" in sinks.card(rows.withColumn("split", F.lit("train")), "T")


def test_dashboard(spark):
    df = spark.createDataFrame([(1, '{"a": [1, {"b": "x"}]}'), (2, "50% off")], "id int, j string")
    assert dashboard.search(df, "50%").count() == 1 and dashboard.search(df, "0_").count() == 0
    assert [r["v"] for r in dashboard.project(df, {"v": "j.a[1].b"}).collect()] == ["x", None]
    with pytest.raises(ValueError):
        dashboard.page(df, ["id"], 1, 5000)


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 1, 10, True), (1, 2, 11, True), (1, 3, 12, False), (1, 4, 13, True)], "group_id long, event_id long, ts long, bad boolean").coalesce(1).write.parquet(src)
    rows = streams.files(spark, src, "group_id long, event_id long, ts long, bad boolean")
    q = streams.run_counters(rows).writeStream.format("memory").queryName("counters").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    assert [(r["errors"], r["streak"]) for r in spark.sql("SELECT * FROM counters ORDER BY event_id").collect()] == [(1, 1), (2, 2), (2, 0), (3, 1)]
    out = str(tmp_path / "out")
    for _ in range(2):
        streams.export_stream(rows.select(F.col("event_id").alias("id"), "bad"), out, str(tmp_path / "e")).awaitTermination(120)
    assert spark.read.json(out).count() == 4


def test_tool_definitions_of_every_shape(spark):
    flat = '[{"name": "f", "description": "d", "parameters": {"a": {"type": "INT", "description": "n"}, "b": {"type": "list", "default": "x"}, "c": {"default": ""}, "e": "plain"}}, {"parameters": ["x"]}, 7, "s", null]'
    got = json.loads(one(spark, tools.openai_tools(F.col("x")), x=flat))
    assert got[0]["function"]["parameters"] == {
        "type": "object", "required": ["a", "c"],
        "properties": {"a": {"type": "integer", "description": "n"}, "b": {"type": "array", "description": ""}, "c": {"type": "string", "description": ""}, "e": {"type": "string", "description": "plain"}},
    }
    assert [t["function"]["name"] for t in got] == ["f", "unknown"] and got[1]["function"]["description"] == "Execute unknown"
    for bad in ("5", "", "no", None, '"x"'):
        assert one(spark, tools.openai_tools(F.col("x")), x=bad) is None
    back = json.loads(one(spark, tools.hermes_tools(F.col("x")), x=json.dumps(got)))
    assert back[0]["parameters"]["a"] == {"description": "n", "type": "integer"} and back[1]["parameters"] == {}
    system = 'a <tools>no</tools> <tools>{"x": 1}</tools> <tools>[{"name": "g"}, {"type": "function", "function": {"name": "h"}}]</tools>'
    assert [t["function"]["name"] for t in json.loads(one(spark, tools.prompt_tools(F.col("x")), x=system))] == ["g", "h"]
    assert one(spark, tools.prompt_tools(F.col("x")), x=None) is None


def test_localization(spark):
    got = lambda s, t, a: one(spark, lang.localization_issues(F.col("s"), F.col("t"), F.col("a"), lang.language("ne-Deva")), s=s, t=t, a=a)
    source, arguments = "Weather in Paris on https://a.b/c for id_7, mail x@y.zz", '{"city": "Paris", "n": {"id": ["id_7", true, 2.0]}}'
    assert got(source, "", arguments) == ["empty_localization"] and got(source, source.upper(), arguments) == ["not_localized"]
    fine = "पेरिस को मौसम Paris मा https://a.b/c हेर्नुहोस् id_7 को लागि x@y.zz"
    assert got(source, fine, arguments) == []
    assert got(source, "मौसम Paris हेर्नुहोस्", arguments) == ["missing_protected_token:https://a.b/c", "missing_protected_token:x@y.zz", "missing_argument_literal:id_7"]
    assert got(source, "the weather of Paris https://a.b/c id_7 x@y.zz", arguments)[0].startswith("insufficient_script_ratio")
    assert one(spark, lang.leaves(F.col("x")), x='{"a": [1, 2.0, 2.5, true, null, {"b": "c"}]}') == ["1", "2", "2.5", "c"]
    assert one(spark, lang.leaves(F.col("x")), x="{") == []


def test_translation_with_nulls_and_references(spark):
    kind = f"s {lang.MESSAGES}, t {lang.MESSAGES}, r {lang.MESSAGES}"
    m = lambda *x: [{"from": w, "value": v} for w, v in zip(("human", "gpt", "human"), x)]
    rows = [(m("Hello there 5kg", "fine words"), m("नमस्ते 5kg", "राम्रो"), None), (m("a b c d e", None), m(None, "x"), None), (None, None, None), (m("one two", "three"), m("एक दुई", "तीन"), m("एक दुई", "तीन")), (m("one two", "three"), m("एक दुई"), m("एक दुई", "तीन"))]
    got = [r["x"] for r in spark.createDataFrame(rows, kind).select(lang.translation("s", "t", "r").alias("x")).collect()]
    assert got[0]["score"] == pytest.approx(1.0) and got[0]["reference"] is None
    assert got[1]["nonempty"] == 0.5 and got[1]["score"] <= 0.49 and got[2]["structure"] == 0.0 and got[2]["protected"] == 1.0
    assert got[3]["reference"] == 1.0 and got[3]["score"] == pytest.approx(0.05 + 0.10 + 0.05 + 0.25 + 0.20 + 0.35)
    assert got[4]["reference"] == 0.0 and got[4]["structure"] == 0.5 and got[4]["script"] == 1.0 and got[4]["score"] <= 0.49


def test_protected_spans_are_the_pattern(spark):
    import re

    texts = ["`a` $x$ 5 kg ५०% see https://e.org/x, a.b@c.de <b>1,5°C</b> \\(y\\) ```p\nq``` naïve7x", "", "no"]
    got = [r["x"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(lang.protected_spans(F.col("t")).alias("x")).collect()]
    assert got == [re.findall(lang.PROTECTED, t, re.S) for t in texts]


def test_records_and_exports_with_odd_rows(spark):
    got = lambda t: tuple(one(spark, exports.translation_output(F.col("x"))["issue"].alias("x"), x=t) for t in t)
    good = '{"conversations": [{"from": "user", "value": "a"}, {"from": "assistant", "value": "b"}]}'
    assert got((None, " ", "```x", "{", "[1]", '{"conversations": 1}', '{"conversations": [], "x": 1}', good)) == ("output is empty", "output is empty", "output is fenced", "output is not JSON", "output has other fields", "messages aren't a list", "output has other fields", None)
    x = '[{"role": "user", "content": [{"text": "a"}, {"type": "t"}, {"text": "b"}]}, {"role": "gpt", "content": "c"}]'
    parts = one(spark, exports.messages_of(F.col("x"), "role", "content"), x=x)
    assert [(r["from"], r["value"]) for r in parts] == [("human", "ab"), ("gpt", "c")]
    assert one(spark, exports.qa_exportable(F.lit(True), F.lit(None).cast("boolean"), F.lit(1.0), 0.5)) is False
    meta = one(spark, exports.qa_metadata(F.lit("p"), F.create_map(F.lit("title"), F.lit("t")), F.lit(None).cast("array<struct<context_policy:string,verifier:string,standalone:boolean>>")))
    assert meta["chapter_title"] == "t" and meta["flattening_safe"] is True and meta["context_policies"] == []


def test_mining_with_repeats_and_nulls(spark):
    texts = spark.createDataFrame([("a  b", 2), ("a b", 1), (None, 3), (" ", 4), ("c", 5)], "text string, place int")
    assert [(r["passage"], r["index"]) for r in mining.pool(texts, spark.createDataFrame([("d", 1), ("c", 2)], texts.schema)).orderBy("index").collect()] == [("a b", 0), ("c", 1), ("d", 2)]
    assert mining.pool(texts.limit(0), texts.limit(0)).count() == 0
    rows = spark.createDataFrame([(1, "Q", "p1"), (2, "q ", "p2"), (3, "z", "p3")], "id int, query string, positive string")
    candidates = spark.createDataFrame([(i, p) for i in (1, 2, 3) for p in ("p1", "p2", "p3")], "id int, passage string")
    assert sorted(map(tuple, mining.without_positives(candidates, rows).select("id", "passage").collect())) == [(1, "p3"), (2, "p3"), (3, "p1"), (3, "p2")]
    v = spark.createDataFrame([(1, k, "Seed", t) for k, t in enumerate(["ab", "seed", "good one", None, "good  one", "देव नागरी"])], "id int, place int, seed string, text string")
    assert [r["reason"] and r["reason"].split()[1] + r["reason"].split()[-1] for r in mining.gated(v, "en-Latn", 0.6).orderBy("place").collect()] == ["isshort", "duplicatesquery", None, "istext", "duplicatesvariant", "doesratio"]
    m = rollouts.session_metrics(spark.createDataFrame([("s", 2, None, 4, 1, True, None), ("s", 1, True, 2, 3, False, 0.5)], "session_id string, step int, success boolean, execution_time_ms int, output_chars int, truncated boolean, reward double")).first()
    assert (m["successful_executions"], m["failed_executions"], m["truncation_count"], m["avg_execution_time_ms"], m["step_rewards"]) == (1, 1, 1, 3.0, [0.5, 0.0])


def test_broken_pages_are_no_pages(spark):
    docs = spark.createDataFrame([(1, [(1, None), (2, "words here")]), (2, None)], "id int, pages array<struct<page:int,text:string>>")
    assert [(r["id"], r["first_page"], r["text"]) for r in chunks.chunked_pages(docs, "id", "pages", 100, 10).collect()] == [(1, 2, "words here")]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from gristmill.session import shared_dir

    sc = SimpleNamespace(master="spark://x:7077", getConf=lambda: {}, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *_: None)))
