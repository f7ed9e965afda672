"""Chat formatting: link tool calls to results, order them, check arguments, write canonical JSON.

A message whose text is a JSON object makes explicit calls (``tool_calls``: a list of objects with
``id``, ``name``, ``arguments`` and optionally ``after``, the id of the call it builds on) or is
the result of one (``tool_call_id``, ``content``). What a message says beside its calls, its
``content``, is a plain text of its own. Any other message is a turn of plain talk, which
is read as calls, too: a user's turn calls ``reply`` under the turn's number, building on the call
two turns before, and the assistant's next turn is its result.

Calls and results are joined by conversation and identifier with a hash join; before it, calls are
reduced to the first one of each identifier and results to their number, so that an identifier
that repeats does not multiply rows. The topological level of a call is the length of the chain of
calls it builds on, found by pointer doubling in as many joins as the logarithm of the longest
chain. The order is given by ``step``, twice the level, and one more for results, so no
conversation is ever gathered in one place. Everything is DataFrame functions.

Defined results: null text is the empty text; other roles and system messages are plain text
without call. Rows without conversation or turn are never linked. Of calls with the same
identifier the one of the smallest turn (then name, then arguments) is linked and the others are
reported, also where whole rows repeat. Plain texts have no step, nor have results without call, calls in a
cycle and calls that build on one. Empty tables give no rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import stored, text_of

#: Tools and their arguments: name, type and whether it must be there.
SCHEMAS = {
    "reply": {"role": ("string", True), "text": ("string", True)},
    "search": {"query": ("string", True), "limit": ("number", False)},
    "run": {"code": ("string", True), "language": ("string", False)},
}
#: What each schema type is called by ``schema_of_variant``.
VARIANT_TYPES = {
    "string": "^STRING$",
    "number": "^(BIGINT|DECIMAL|DOUBLE)",
    "boolean": "^BOOLEAN$",
    "object": "^OBJECT",
    "array": "^ARRAY",
}
EXPLICIT = (
    "struct<tool_calls:array<struct<id:string,name:string,arguments:string,after:string>>,"
    "tool_call_id:string,content:string>"
)
CALL, RESULT, TEXT = "call", "result", "text"

Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]


def messages(turns: DataFrame) -> DataFrame:
    """One row per call, result or plain text of ``turns`` (conv_id, turn, role, text)."""
    text, role, turn = F.col("text"), F.col("role"), F.col("turn")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        text_of("text").alias("text"),
    ).withColumn(
        "said", F.when(F.substring(text, 1, 1) == "{", F.from_json(text, EXPLICIT))
    )
    calls = F.col("said.tool_calls")
    plain_call = F.struct(
        turn.cast("string").alias("id"),
        F.lit("reply").alias("name"),
        F.to_json(F.struct(role.alias("role"), text.alias("text"))).alias("arguments"),
        F.when(turn >= 2, (turn - 2).cast("string")).alias("after"),
    )
    nothing = F.lit(None).cast("string")
    plain = F.struct(
        nothing.alias("id"), nothing.alias("name"), nothing.alias("arguments"),
        nothing.alias("after"),
    )
    explicit = F.size(F.coalesce(calls, F.array().cast(_array_type()))) > 0
    beside = F.coalesce("said.content", F.lit(""))
    spoken = F.lit(None).cast(_call_type())
    kind = (
        F.when(explicit, CALL)
        .when(F.col("said.tool_call_id").isNotNull(), RESULT)
        .when(role == "user", CALL)
        .when((role == "assistant") & (turn >= 1), RESULT)
        .otherwise(TEXT)
    )
    rows = rows.withColumn("kind", kind)
    each = (
        F.when(explicit & (beside != ""), F.concat(calls, F.array(spoken)))
        .when(explicit, calls)
        .when(F.col("kind") == CALL, F.array(plain_call))
        .otherwise(F.array(plain))
    )
    answered = F.coalesce("said.tool_call_id", (turn - 1).cast("string"))
    content = F.when(F.col("said.tool_call_id").isNotNull(), F.coalesce("said.content", F.lit("")))
    # Of the calls of a message, the last one, which is null, stands for what it says beside them.
    is_spoken = explicit & (beside != "") & (F.col("at") == F.size(calls))
    return rows.select(
        "conv_id", "turn", "role", "kind", "text", "said", F.posexplode(each).alias("at", "call")
    ).select(
        "*", F.when(is_spoken, F.lit(True)).otherwise(False).alias("spoken")
    ).select(
        "conv_id",
        "turn",
        "role",
        F.when(F.col("spoken"), TEXT).otherwise(F.col("kind")).alias("kind"),
        F.when(F.col("kind") == RESULT, answered).otherwise(F.col("call.id")).alias("call_id"),
        F.col("call.name").alias("name"),
        F.col("call.arguments").alias("arguments"),
        F.col("call.after").alias("after"),
        F.when(F.col("spoken"), beside).otherwise(F.coalesce(content, "text")).alias("content"),
    )


def _call_type() -> str:
    return "struct<id:string,name:string,arguments:string,after:string>"


def _array_type() -> str:
    return f"array<{_call_type()}>"


def _linked(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """A left join that hashes ``right``, which has one row per key."""
    return left.join(right.hint("shuffle_hash"), on, "left")


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id and ``level`` of ``calls`` (conv_id, call_id, after), one row per call.

    Each round doubles the length of the chain that a call looks back on. A call that still has
    an ancestor after as many rounds as the number of calls has bits is in a cycle or builds on
    one; its level is null.
    """
    keys = ["conv_id", "call_id"]
    known = calls.select("conv_id", F.col("call_id").alias("back"), F.lit(True).alias("known"))
    now = stored(
        _linked(calls.withColumn("back", F.col("after")), known, ["conv_id", "back"]).select(
            *keys,
            F.when(F.col("known"), F.col("back")).alias("back"),
            F.when(F.col("known"), 1).otherwise(0).cast("long").alias("level"),
        ),
        "calls",
    )
    for _ in range(now.count().bit_length() + 1):
        if now.filter("back is not null").isEmpty():
            break
        above = now.select(
            "conv_id",
            F.col("call_id").alias("back"),
            F.col("back").alias("further"),
            F.col("level").alias("higher"),
        )
        now = stored(
            _linked(now, above, ["conv_id", "back"]).select(
                *keys,
                F.col("further").alias("back"),
                (F.col("level") + F.coalesce("higher", F.lit(0))).alias("level"),
            ),
            "levels",
        )
    return now.select(*keys, F.when(F.col("back").isNull(), F.col("level")).alias("level"))


def problems(schemas: Schemas = SCHEMAS) -> Column:
    """What is wrong with a call's ``name`` and ``arguments``: an array of texts."""
    args = F.try_parse_json(F.col("arguments"))
    is_object = F.coalesce(F.schema_of_variant(args).startswith("OBJECT"), F.lit(False))
    empty = F.array().cast("array<string>")
    checks = F.array(F.concat(F.lit("unknown tool "), F.coalesce("name", F.lit("null"))))
    for tool, fields in schemas.items():
        found = []
        for name, (kind, required) in fields.items():
            value = F.try_variant_get(args, f"$['{name}']", "variant")
            fits = F.schema_of_variant(value).rlike(VARIANT_TYPES[kind])
            wrong = F.when(value.isNotNull() & ~fits, F.lit(f"{name} is not a {kind}"))
            missing = F.when(value.isNull(), F.lit(f"{name} is missing")) if required else wrong
            found.append(F.coalesce(missing, wrong))
        strange = F.transform(
            F.array_sort(
                F.array_except(F.json_object_keys("arguments"), F.array(*map(F.lit, fields)))
            ),
            lambda key: F.concat(key, F.lit(" is not expected")),
        )
        of_tool = F.concat(F.filter(F.array(*found), lambda p: p.isNotNull()), strange)
        checks = F.when(F.col("name") == tool, of_tool).otherwise(checks)
    not_object = F.array(F.lit("arguments are not an object"))
    return F.when(
        F.col("kind") == CALL, F.when(~is_object, not_object).otherwise(checks)
    ).otherwise(empty)


def canonical() -> Column:
    """A message as JSON with sorted keys, without spaces and nulls.

    Arguments go through the variant type, whose objects keep their fields in order of names;
    arguments that are no JSON stay a string.
    """
    args = F.coalesce(
        F.try_parse_json(F.col("arguments")),
        F.try_parse_json(F.to_json(F.struct(F.col("arguments").alias("raw")))),
    )
    call = F.struct(
        args.alias("arguments"), "call_id", "name", "role", F.col("kind").alias("type")
    )
    result = F.struct("call_id", "content", "role", F.col("kind").alias("type"))
    text = F.struct("content", "role", F.col("kind").alias("type"))
    return (
        F.when(F.col("kind") == CALL, F.to_json(call))
        .when(F.col("kind") == RESULT, F.to_json(result))
        .otherwise(F.to_json(text))
    )


def link(turns: DataFrame, schemas: Schemas = SCHEMAS) -> DataFrame:
    """Every call, result and text with its order, link, problems and canonical JSON.

    Columns: conv_id, turn, role, kind, call_id, step (-1 where there is none), linked, problems
    (joined by semicolons), json.
    """
    keys = ["conv_id", "call_id"]
    said = messages(turns)
    first = F.struct("turn", "name", "arguments", "after")
    calls = (
        said.filter((F.col("kind") == CALL) & F.col("conv_id").isNotNull())
        .filter("turn is not null and call_id is not null")
        .groupBy(*keys)
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n_calls"))
        .select(*keys, "n_calls", F.col("first.turn").alias("call_turn"), "first.after")
    )
    calls = stored(calls, "first-calls")
    results = (
        said.filter(F.col("kind") == RESULT)
        .filter("turn is not null")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_results"))
    )
    known = _linked(
        _linked(calls.drop("after"), levels(calls.select(*keys, "after")), keys), results, keys
    )
    rows = _linked(said, stored(known, "known-calls"), keys)
    is_call, is_result = F.col("kind") == CALL, F.col("kind") == RESULT
    linked = (
        F.when(is_call, F.col("n_results").isNotNull() & (F.col("turn") == F.col("call_turn")))
        .when(is_result, F.col("n_calls").isNotNull() & F.col("turn").isNotNull())
        .otherwise(False)
    )
    more = F.array(
        F.when(is_call & (F.col("n_calls") > 1), F.lit("repeated call id")),
        F.when(is_result & F.col("n_calls").isNull(), F.lit("no such call")),
        F.when(F.col("n_calls").isNotNull() & F.col("level").isNull(), F.lit("cycle of calls")),
    )
    every = F.concat(problems(schemas), F.filter(more, lambda p: p.isNotNull()))
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "kind",
        "call_id",
        F.coalesce(2 * F.col("level") + F.when(is_result, 1).otherwise(0), F.lit(-1)).alias(
            "step"
        ),
        F.coalesce(linked, F.lit(False)).alias("linked"),
        F.array_join(every, "; ").alias("problems"),
        canonical().alias("json"),
    )
