"""What goes out: records in their three forms, model output read back, export tests, flattened rows and metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.tools import prompt_tools
from gristmill.operators.conversations import problem, role

MESSAGES = "array<struct<from:string,value:string>>"


def _json(x: Column) -> Column:
    """A string as JSON text."""
    whole = F.to_json(F.array(x))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def record_id(conversation: Column, *ids: Column) -> Column:
    """The first id that isn't blank, else a hash of the conversation's JSON text."""
    spelled = F.transform(conversation, lambda m: F.concat(F.lit('{"from": '), _json(m["from"]), F.lit(', "value": '), _json(m["value"]), F.lit("}")))
    made = F.concat(F.lit("sharegpt-"), F.substring(F.sha2(F.concat(F.lit("["), F.array_join(spelled, ", "), F.lit("]")), 256), 1, 20))
    return F.coalesce(*(F.nullif(F.trim(i.cast("string")), F.lit("")) for i in ids), made)


def messages_of(x: Column, who: str = "from", what: str = "value") -> Column:
    """JSON text of messages as a conversation with canonical roles; the parts of a content list are joined."""
    rows = F.from_json(x, f"array<struct<`{who}`:string,`{what}`:string>>")
    parts = lambda t: F.array_join(F.transform(F.from_json(t, "array<struct<text:string>>"), lambda p: F.coalesce(p["text"], F.lit(""))), "")
    text = lambda t: F.when(t.startswith("[{"), F.coalesce(parts(t), t)).otherwise(t)
    return F.transform(rows, lambda m: F.struct(role(m[who]).alias("from"), F.trim(text(m[what])).alias("value")))


def normalized_record(conversations: Column, messages: Column, instruction: Column, response: Column, system: Column) -> Column:
    """(conversation, input_format, issue) of a row in one of three forms; the first that is there counts. Arguments: JSON text
    of messages with from and value, of messages with role and content, and three texts."""
    turn = lambda who, x: F.struct(F.lit(who).alias("from"), F.trim(x).alias("value"))
    pair = F.array(turn("human", instruction), turn("gpt", response))
    flat = F.when(F.trim(F.coalesce(system, F.lit(""))) != "", F.concat(F.array(turn("system", system)), pair)).otherwise(pair)
    kind = F.when(conversations.isNotNull(), "sharegpt").when(messages.isNotNull(), "openai-messages").when(instruction.isNotNull() & response.isNotNull(), "hermes-instruction-response")
    found = F.when(conversations.isNotNull(), messages_of(conversations)).when(messages.isNotNull(), messages_of(messages, "role", "content")).when(instruction.isNotNull() & response.isNotNull(), flat)
    blank = F.exists(found, lambda m: F.coalesce(m["value"], F.lit("")) == "")
    issue = F.when(kind.isNull(), "no known form").when(found.isNull(), "messages aren't a list").otherwise(F.coalesce(problem(found), F.when(blank, "empty message")))
    return F.struct(F.when(issue.isNull(), found).alias("conversation"), kind.alias("input_format"), issue.alias("issue"))


def translation_output(x: Column) -> Column:
    """(conversation, issue) of a model's output, which has to be a JSON object with the conversations and nothing else."""
    t = F.trim(F.coalesce(x, F.lit("")))
    keys, found = F.json_object_keys(t), messages_of(F.get_json_object(t, "$.conversations"))
    issue = (
        F.when(t == "", "output is empty")
        .when(t.startswith("```"), "output is fenced")
        .when(F.try_parse_json(t).isNull(), "output is not JSON")
        .when(~F.coalesce(F.array_sort(keys) == F.array(F.lit("conversations")), F.lit(False)), "output has other fields")
        .when(found.isNull(), "messages aren't a list")
        .otherwise(problem(found))
    )
    return F.struct(F.when(issue.isNull(), found).alias("conversation"), issue.alias("issue"))


def translation_exportable(parsed: Column, source: Column, answer_correct: Column, reward: Column, score: Column, least: float = 0.8) -> Column:
    """Whether a translation goes out: known to be correct, reward and score verified anew both high enough, and roles as in the source."""
    roles = lambda c: F.transform(c, lambda m: m["from"])
    return F.coalesce(answer_correct & (reward >= least) & (score >= least) & (roles(parsed["conversation"]) == roles(source)), F.lit(False))


def qa_exportable(success: Column, answer_correct: Column, reward: Column, least: float) -> Column:
    """Whether questions and answers go out: success, known to be correct, and enough reward. Unknown is no."""
    return F.coalesce(success & answer_correct & (reward >= least), F.lit(False))


def qa_metadata(profile: Column, provenance: Column, plans: Column) -> Column:
    """Metadata of an export: provenance (map) lifted out, and of the question plans (array of context_policy, verifier,
    standalone) their policies, verifiers and whether all stand alone."""
    get = lambda k: F.try_element_at(provenance, F.lit(k))
    plans = F.coalesce(plans, F.array().cast("array<struct<context_policy:string,verifier:string,standalone:boolean>>"))
    return F.struct(
        profile.alias("profile"), get("subject").alias("subject"), get("grade").alias("grade"), get("title").alias("chapter_title"),
        F.transform(plans, lambda p: p["context_policy"]).alias("context_policies"), F.transform(plans, lambda p: p["verifier"]).alias("verifiers"),
        F.forall(plans, lambda p: F.coalesce(p["standalone"], F.lit(False))).alias("flattening_safe"),
    )


def flattened(rows, provenance: list[str], lead: tuple[str, ...] = ("id", "conversations", "tools", "category", "subcategory", "task")):
    """Export rows (id, conversations, tools JSON text, source_provenance map, ...) with the named entries of their provenance as
    columns, tools found in the system prompt where there are none, nested values as JSON text, and the leading columns first."""
    system = F.get(F.filter("conversations", lambda m: m["from"] == "system"), F.lit(0))["value"]
    tools = F.coalesce(F.nullif(F.nullif(F.trim("tools"), F.lit("")), F.lit("[]")), prompt_tools(system)).alias("tools")
    lifted = [F.try_element_at("source_provenance", F.lit(k)).alias(k) for k in provenance if k not in ("id", "conversations", "tools")]
    taken = {"id", "conversations", "tools", "source_provenance", *provenance}
    rest = [F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(c) for c, kind in rows.dtypes if c not in taken]
    out = rows.select("id", "conversations", tools, *lifted, *rest)
    return out.select(*(c for c in lead if c in out.columns), *(c for c in out.columns if c not in lead))
