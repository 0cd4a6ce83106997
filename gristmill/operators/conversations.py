"""Conversations: role names, validity, ShareGPT and message forms, chat history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Role names and what they are called in ShareGPT conversations.
ROLES = {"system": "system", "human": "human", "user": "human", "gpt": "gpt", "assistant": "gpt", "tool": "tool", "function": "tool"}


def role(x: Column) -> Column:
    """Canonical role; null for an unknown one."""
    return F.try_element_at(F.create_map(*(F.lit(v) for p in ROLES.items() for v in p)), F.lower(F.trim(x)))


def gathered(turns: DataFrame, key: str = "conv_id", order: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(key, conversation): turns in order as array of (from, value). A conversation is one row, so it has to fit in memory."""
    rows = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role_col).alias("r"), F.col(text_col).alias("v")))).alias("t"))
    return rows.select(key, F.transform("t", lambda x: F.struct(role(x["r"]).alias("from"), x["v"].alias("value"))).alias("conversation"))


def problem(conversation: Column) -> Column:
    """Why a conversation can't be used, null if it can: unknown role, fewer than two messages, or no human or gpt message."""
    roles = F.transform(conversation, lambda m: m["from"])
    return (
        F.when(F.exists(roles, lambda r: r.isNull()), "unsupported role")
        .when(F.size(conversation) < 2, "fewer than two messages")
        .when(~F.array_contains(roles, "human") | ~F.array_contains(roles, "gpt"), "needs human and gpt messages")
    )


def repeats_role(conversation: Column) -> Column:
    """Whether two messages in a row have one role."""
    n = F.size(conversation)
    pairs = F.zip_with(F.slice(conversation, 1, F.greatest(n - 1, F.lit(0))), F.slice(conversation, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: a["from"].eqNullSafe(b["from"]))
    return F.exists(pairs, lambda x: x)


def built(turns: Column, system: Column, reasoning: bool = True) -> Column:
    """A ShareGPT conversation of turns (role, content, reasoning): null if two messages in a row have one role.

    A user turn with "[System]" is a correction: it and a gpt message just before it are left out.
    """
    kind = "array<struct<from:string,value:string>>"
    first = F.array(F.struct(F.lit("system").alias("from"), system.alias("value"))).cast(kind)
    start = F.struct(first.alias("c"), F.lit(True).alias("ok"))

    def step(a: Column, t: Column) -> Column:
        who = F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").when(t["role"] == "tool", "tool").otherwise("unknown")
        last = F.element_at(a["c"], -1)["from"]
        value = F.when(F.coalesce(t["reasoning"], F.lit("")) != "", F.concat(F.lit("<think>\n"), t["reasoning"], F.lit("\n</think>\n\n"), t["content"])).otherwise(t["content"]) if reasoning else t["content"]
        fixed = (t["role"] == "user") & t["content"].contains("[System]")
        without = F.when(last == "gpt", F.slice(a["c"], 1, F.greatest(F.size(a["c"]) - 1, F.lit(0)))).otherwise(a["c"])
        more = F.concat(a["c"], F.array(F.struct(who.alias("from"), value.alias("value"))).cast(kind))
        return F.when(~a["ok"], a).when(fixed, F.struct(without.alias("c"), F.lit(True).alias("ok"))).when(who == last, F.struct(a["c"].alias("c"), F.lit(False).alias("ok"))).otherwise(F.struct(more.alias("c"), F.lit(True).alias("ok")))

    return F.aggregate(turns, start, step, lambda a: F.when(a["ok"], a["c"]))


def prompt_and_history(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """(key, prompt, n_history): the last user message and the number of messages before it."""
    users = turns.filter("role = 'user'").groupBy(key).agg(F.max_by("text", order).alias("prompt"), F.max(order).alias("__last"))
    return turns.join(users, key).groupBy(key, "prompt").agg(F.count_if(F.col(order) < F.col("__last")).alias("n_history"))


def exact_dialogue(conversation: Column, turns: Column) -> Column:
    """The conversation if it has exactly two non-blank messages a turn, else null."""
    return F.when((F.size(conversation) == 2 * turns) & F.forall(conversation, lambda m: F.trim(m["value"]) != ""), conversation)


def as_messages(conversation: Column) -> Column:
    """array of (role, content) with the usual role names."""
    who = lambda m: F.when(m["from"] == "human", "user").when(m["from"] == "gpt", "assistant").otherwise(m["from"])
    return F.transform(conversation, lambda m: F.struct(who(m).alias("role"), m["value"].alias("content")))
