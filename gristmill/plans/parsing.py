"""Validators and parsers on documents. Constraints and markup are put into the texts by rule where the tables have none."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import parse as P
from gristmill.functions import tools
from gristmill.functions import text as T
from gristmill.functions import validators as V
from gristmill.plans.registry import query, table

_W = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"
_CAP = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: regexp_full_match(w, '\\pL+') AND regexp_matches(w, '\\p{Lu}') AND NOT regexp_matches(w, '[\\p{Ll}\\p{Lt}]')))"
_PARTS = "len(list_filter(string_split(text, {s}), lambda p: trim(p, E' \\t\\n\\r') <> ''))"
#: Name, Spark parameters, SQL over text.
CHECKS = {
    "lowercase": ("validate_lowercase", {}, "NOT regexp_matches(text, '\\p{Lu}')"),
    "no_commas": ("validate_no_commas", {}, "NOT contains(text, ',')"),
    "quotation": ("validate_quotation", {}, "starts_with(trim(text), '\"') AND ends_with(trim(text), '\"')"),
    "paragraph_count": ("verify_paragraph_count", {"N": 1}, _PARTS.format(s="'***'") + " = 1"),
    "paragraphs": ("validate_paragraphs", {"N": 1}, _PARTS.format(s="chr(10) || chr(10)") + " = 1"),
    "highlighted": ("validate_highlighted_sections", {"N": 1}, "len(regexp_extract_all(text, '\\*([^*]+)\\*')) >= 1"),
    "keyword_frequency": ("verify_keyword_frequency", {"keyword_list": ["the"], "N": 3}, "(length(lower(text)) - length(replace(lower(text), 'the', ''))) / 3 = 3"),
    "letter_frequency": ("verify_letter_frequency", {"letter": "e", "N": 40, "quantifier": "at least"}, "length(lower(text)) - length(replace(lower(text), 'e', '')) >= 40"),
    "capital_words": ("validate_frequency_capital_words", {"N": 2, "quantifier": "at most"}, _CAP + " <= 2"),
    "repeat_prompt": ("validate_repeat_prompt", {"original_prompt": "The"}, "starts_with(trim(text), 'The')"),
    "postscript": ("validate_postscript", {"postscript_marker": "A"}, "list_bool_or(list_transform(string_split(trim(text, E' \\t\\n\\r'), chr(10))[-3:], lambda x: starts_with(trim(x), 'A')))"),
    "forbidden_words": ("validate_forbidden_words", {"forbidden_words": ["idiot", "Stupid"]}, "NOT (contains(lower(text), 'idiot') OR contains(lower(text), 'stupid'))"),
    "end_checker": ("validate_end_checker", {"end_phrase": "."}, "ends_with(trim(text, E' \\t\\n\\r'), '.')"),
    "word": ("validate_word_constraint", {"word": "The"}, "contains(lower(text), 'the')"),
    "number_of_words": ("validate_number_of_words", {"N": 100, "quantifier": "at least"}, _W + " >= 100"),
    "sections": ("validate_sections", {"N": 2, "section_splitter": " | "}, _PARTS.format(s="' | '") + " = 2"),
    "choice": ("validate_choice", {"options": ["yes", "no"]}, "trim(text) IN ('yes', 'no')"),
    "placeholders": ("validate_placeholders", {"N": 1}, "len(regexp_extract_all(text, '\\[([^\\]]+)\\]')) >= 1"),
    "title": ("validate_title", {}, "list_bool_or(list_transform(string_split(text, chr(10)), lambda x: starts_with(trim(x), '#')))"),
    "two_responses": ("validate_two_responses", {}, "(regexp_matches(text, '(?i)1\\.|Response 1') AND regexp_matches(text, '(?i)2\\.|Response 2')) OR contains(text, '***') OR contains(text, chr(10) || chr(10))"),
    "bullet_points": ("verify_bullet_points", {"N": 1}, "len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\\s*[-*•]\\s+'))) >= 1"),
    "keywords": ("verify_keywords", {"forbidden_words": ["the", "of"]}, "contains(lower(text), 'the') AND contains(lower(text), 'of')"),
}


def _check(name: str, params: dict, sql: str, key: str) -> None:
    def run(spark, d):
        return table(spark, d, "documents").select("doc_id", V.VALIDATORS[name](F.col("text"), **params).alias("ok"))

    query(f"SELECT doc_id, {sql} AS ok FROM documents", name=f"ifeval_{key}")(run)


for _key, (_name, _params, _sql) in CHECKS.items():
    _check(_name, _params, _sql, _key)


@query("SELECT event_id, json_valid(CASE WHEN event_id % 3 = 0 THEN left(props, 5) ELSE props END) AS ok FROM events")
def ifeval_json_format(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.substring("props", 1, 5)).otherwise(F.col("props")).alias("t"))
    return e.select("event_id", V.json_format(F.col("t")).alias("ok"))


_CONSTRAINT = "CASE doc_id % 5 WHEN 0 THEN '{\"func_name\": \"validate_no_commas\"}' WHEN 1 THEN '{\"func_name\": \"validate_number_of_words\", \"N\": 200, \"quantifier\": \"at most\"}' WHEN 2 THEN '{\"func_name\": \"nothing\"}' WHEN 3 THEN '{\"func_name\": \"validate_number_of_words\"}' ELSE '{}' END"


@query(f"SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN NOT contains(text, ',') WHEN 1 THEN {_W} <= 200 WHEN 3 THEN true END AS ok, CASE WHEN CASE doc_id % 5 WHEN 0 THEN NOT contains(text, ',') WHEN 1 THEN {_W} <= 200 WHEN 3 THEN true ELSE false END THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM documents")
def ifeval_dispatch(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.from_json(F.expr(_CONSTRAINT), V.CONSTRAINT).alias("c"))
    return docs.select("doc_id", V.verified(F.col("text"), F.col("c")).alias("ok"), V.constraint_reward(F.col("text"), F.col("c")).alias("reward"))


_MARKED = "SELECT doc_id, '<think>' || left(text, 10) || '</think> a <python> x = ' || doc_id || ' </python> \\boxed{' || doc_id || '} <final_answer> ' || (doc_id * 2) || ' </final_answer><tool_call>{\"name\": \"f\", \"arguments\": {\"b\": 1.0, \"a\": ' || doc_id || '}}</tool_call>' || CASE WHEN doc_id % 4 = 0 THEN '<repl>x</repl>' ELSE '' END AS t FROM documents"


def _marked(spark, d):
    docs = table(spark, d, "documents")
    i = F.col("doc_id").cast("string")
    t = F.concat(F.lit("<think>"), F.col("text"), F.lit("</think> a <python> x = "), i, F.lit(" </python> \\boxed{"), i, F.lit("} <final_answer> "), (F.col("doc_id") * 2).cast("string"), F.lit(' </final_answer><tool_call>{"name": "f", "arguments": {"b": 1.0, "a": '), i, F.lit("}}</tool_call>"), F.when(F.col("doc_id") % 4 == 0, "<repl>x</repl>").otherwise(""))
    return docs.select("doc_id", t.alias("t"))


@query(f"SELECT doc_id, 'x = ' || doc_id AS code, doc_id::VARCHAR AS boxed, (doc_id * 2)::VARCHAR AS answer, doc_id % 4 = 0 AS invented, true AS ordered FROM ({_MARKED})")
def parse_tags(spark, d):
    t = F.col("t")
    return _marked(spark, d).select("doc_id", P.python_blocks(t)[0].alias("code"), P.boxed_answers(t)[0].alias("boxed"), P.final_answer(t).alias("answer"), P.invents_system_tags(t, allow_think=True).alias("invented"), P.thinks_then_calls(t).alias("ordered"))


@query("""SELECT doc_id, 'f' AS name, '{"a": ' || doc_id || ', "b": 1}' AS arguments, doc_id % 2 = 0 AS matches FROM documents""")
def parse_tool_calls(spark, d):
    c = _marked(spark, d).select("doc_id", P.tool_calls(F.col("t")).alias("c"))
    want = F.concat(F.lit('{"name": "f", "arguments": "{\\"a\\": '), F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).otherwise(-1).cast("string"), F.lit(', \\"b\\": true}"}'))
    return c.select("doc_id", F.col("c")[0]["name"].alias("name"), F.col("c")[0]["arguments"].alias("arguments"), P.calls_match(F.col("c"), P.native_tool_calls(want)).alias("matches"))


@query()
def parse_code_blocks(spark, d):
    return _marked(spark, d).select("doc_id", F.to_json(P.code_blocks(F.col("t"))).alias("blocks"))


#: A document as a flat tool: its source is the name, its text the description of a parameter.
_TOOL = """'{"name":"f","description":"' || source || '","parameters":{"x":{"description":' || to_json(text) || ',"type":"integer"},"y":{"description":"","type":"array"}}}'"""


@query(f"SELECT doc_id, '[' || {_TOOL} || ']' AS flat, '<tool_call>' || chr(10) || '{{\"name\": \"' || source || '\", \"arguments\": {{}}}}' || chr(10) || '</tool_call>' AS call FROM documents")
def hermes_tools(spark, d):
    """Documents as flat tool definitions, put into the function-calling form and back."""
    text = F.to_json(F.array("text"))
    x = F.concat(F.lit('{"type": "int", "description": '), F.substring(text, F.lit(2), F.length(text) - 2), F.lit("}"))
    flat = F.concat(F.lit('[{"name": "f", "description": "'), F.col("source"), F.lit('", "parameters": {"x": '), x, F.lit(', "y": {"type": "list", "default": "a"}}}]'))
    wrapped = table(spark, d, "documents").select("doc_id", "source", tools.openai_tools(flat).alias("tools"))
    return wrapped.select("doc_id", tools.hermes_tools(F.col("tools")).alias("flat"), P.hermes_call(F.col("source"), F.lit("{}")).alias("call"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN (doc_id % 10)::DOUBLE ELSE 7.5 END AS score FROM documents")
def judge_scores(spark, d):
    said = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('```json\n{"score": '), (F.col("doc_id") % 10).cast("string"), F.lit("}\n```"))).otherwise("I give it 7.5 of 10")
    return table(spark, d, "documents").select("doc_id", P.judge_score(said).alias("score"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents")
def squeeze_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.squeeze(F.col("text")).alias("text"))


@query("SELECT doc_id, replace(lower(trim(regexp_replace(nfc_normalize(text), '\\s+', ' ', 'g'))), 'ß', 'ss') AS key FROM documents")
def normalize_key(spark, d):
    """A key for every document; of what these texts hold, folding differs from lower-casing in the sharp s alone."""
    return table(spark, d, "documents").select("doc_id", T.normalize_key(F.col("text")).alias("key"))


@query("SELECT page_id, left(trim(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), '_'), 60) AS slug FROM pages")
def slugs(spark, d):
    return table(spark, d, "pages").select("page_id", T.slug(F.col("url")).alias("slug"))


@query("SELECT doc_id, i::INT AS piece, substr(text, i * 1000 + 1, 1000) AS t FROM (SELECT doc_id, text, unnest(range(0, greatest(1, ceil(length(text) / 1000)::INT))) AS i FROM documents)")
def fixed_pieces(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.pieces(F.col("text"), 1000)).alias("piece", "t"))


@query()
def grep_lines(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(T.matching_lines(F.col("text"), "the")).alias("m")).select("doc_id", "m.line", "m.text")
