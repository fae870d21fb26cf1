"""Chat formatting in budgeted windows.

A conversation is cut between turns into spans whose tokens fit a budget, found from the prefix sums
of its turns' tokens. A window holds the leading system turn, a limited history of turns repeated from
before, and the turns of its span. The loss mask covers the assistant texts of the span; what is
repeated is masked, so every assistant text counts once.

A turn is ``### role: text</turn>`` and a line feed. In roles and texts a backslash becomes ``\\b``, ``###``
becomes ``\\h``, ``</turn>`` becomes ``\\l``, and a colon in a role becomes ``\\c``; so no text looks like the
template, and reading back is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import small_frame
from dayferry.llm.text import let, word_count

BUDGET = 1024
HISTORY_TOKENS = 192
HISTORY_TURNS = 6
TURN_TOKENS = 4  # of the template around a text
TARGET_ROLE = "assistant"
SYSTEM_ROLE = "system"
OPEN, SEP, CLOSE = "### ", ": ", "</turn>\n"
_CODES = [("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\l")]


def _escape(text: Column) -> Column:
    for plain, code in _CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _unescape(text: Column) -> Column:
    for plain, code in reversed(_CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _spans(turns: Column, budget: Column) -> Column:
    """Places of the turns that start a span: a turn starts one if with it the sums since the last start pass the budget."""
    state = F.struct(
        F.lit(0).cast("bigint").alias("since"), F.array().cast("array<int>").alias("starts"), F.lit(0).alias("i")
    )

    def step(acc: Column, turn: Column) -> Column:
        new = (F.size(acc["starts"]) == 0) | (turn["upto"] - acc["since"] > budget)
        return F.struct(
            F.when(new, turn["upto"] - turn["tokens"]).otherwise(acc["since"]).alias("since"),
            F.when(new, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"),
            (acc["i"] + 1).alias("i"),
        )

    return F.aggregate(turns, state, step, lambda acc: acc["starts"])


def _window(turns: Column, system: Column, number: Column, first: Column, end: Column, history: int, most: int) -> Column:
    """The window of the turns first..end-1 (from 0): the places of all its turns, and how many of them it repeats."""
    lead = F.when(system & (first > 0), F.lit(1)).otherwise(F.lit(0))
    # The history: the latest turns before the span, as many as fit both limits.
    before = F.get(turns, first)["upto"] - F.get(turns, first)["tokens"]
    recent = F.filter(
        F.sequence(F.greatest(first - most, lead), first),
        lambda i: (i == first) | (before - F.get(turns, i)["upto"] + F.get(turns, i)["tokens"] <= history),
    )
    leading = F.when(lead == 1, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return let(
        F.array_min(recent),
        lambda at: F.struct(
            number.alias("window"),
            F.concat(leading, F.sequence(at, end - 1)).alias("places"),
            (lead + first - at).alias("repeated"),
            (end - first).alias("turns"),
        ),
    )


def _loss(parts: Column, repeated: Column) -> Column:
    """Start and length, in code points, of the targets among a window's turns that it does not repeat."""
    ends = F.transform(parts, lambda t, i: F.aggregate(F.slice(parts, 1, i + 1), F.lit(0), lambda a, u: a + F.length(u["shown"])))
    spans = F.zip_with(
        F.transform(parts, lambda t, i: F.struct(t["target"] & (i >= repeated), t["chars"])),
        ends,
        lambda t, end: F.when(t["col1"], F.struct((end - t["chars"] - F.lit(len(CLOSE))).alias("start"), t["chars"].alias("length"))),
    )
    return F.filter(spans, lambda s: s.isNotNull())


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history_tokens: int = HISTORY_TOKENS,
    history_turns: int = HISTORY_TURNS,
    target_role: str = TARGET_ROLE,
    system_role: str = SYSTEM_ROLE,
    tokens: Callable[[Column], Column] = word_count,
) -> DataFrame:
    """conv_id, window, text, loss (start and length in code points), repeated, turns, tokens.

    The input has conv_id, turn, role and text; other columns take no part. Rows of one conversation are
    ordered by turn, null first, ties by role and text; rows that repeat are turns of their own. A null
    text or role is an empty one, rows without conv_id are one conversation. A turn is never cut: one
    that alone passes the budget has a window of its own. An empty table gives no windows. Of a whole
    conversation only numbers meet in one row, where the spans are found; texts meet by window.
    """
    clean = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    counted = clean.withColumn("tokens", tokens(F.col("body")) + F.lit(TURN_TOKENS))
    counted = counted.withColumn("upto", F.sum("tokens").over(running)).withColumn("place", F.row_number().over(order) - 1)
    numbers = counted.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "tokens", "upto"))).alias("turns"),
        F.bool_or((F.col("place") == 0) & (F.col("role") == system_role)).alias("system"),
    )
    lead = F.when(F.col("system"), F.get("turns", F.lit(0))["tokens"]).otherwise(F.lit(0))
    room = F.greatest(F.lit(budget) - F.lit(history_tokens) - lead, F.lit(1))
    starts = numbers.select("conv_id", "turns", "system", _spans(F.col("turns"), room).alias("starts"))

    def window(first: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("turns"))
        return _window(F.col("turns"), F.col("system"), k, first, end, history_tokens, history_turns)

    made = starts.select("conv_id", F.explode(F.transform("starts", window)).alias("w"))
    wanted = made.select("conv_id", "w.window", "w.repeated", "w.turns", F.explode("w.places").alias("wanted"))
    said = counted.select(F.col("conv_id").alias("of"), "place", "tokens", "role", "body")
    joined = wanted.join(said, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("wanted") == F.col("place")))
    name = F.replace(_escape(F.col("role")), F.lit(":"), F.lit("\\c"))
    part = F.struct(
        "place", "tokens", (F.col("role") == target_role).alias("target"), F.length("escaped").alias("chars"),
        F.concat(F.lit(OPEN), name, F.lit(SEP), F.col("escaped"), F.lit(CLOSE)).alias("shown"),
    )
    parts = joined.withColumn("escaped", _escape(F.col("body"))).select("conv_id", "window", "repeated", "turns", part.alias("part"))
    windows = parts.groupBy("conv_id", "window", "repeated", "turns").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return windows.select(
        "conv_id",
        "window",
        F.array_join(F.transform("parts", lambda t: t["shown"]), "").alias("text"),
        _loss(F.col("parts"), F.col("repeated")).alias("loss"),
        "repeated",
        "turns",
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, t: a + t["tokens"]).alias("tokens"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """conv_id, window, turns (role and text of those not repeated), targets (texts under the loss mask), chars."""
    pieces = F.split("text", CLOSE)
    own = F.slice(pieces, F.col("repeated") + 1, F.greatest(F.size(pieces) - 1 - F.col("repeated"), F.lit(0)))

    def parse(turn: Column) -> Column:
        at = F.position(F.lit(SEP), turn)  # a role has no colon, and the opening has none
        role = F.substring(turn, F.lit(len(OPEN) + 1), at - F.lit(len(OPEN) + 1))
        text = F.substring(turn, at + F.lit(len(SEP)), F.length(turn))
        return F.struct(
            _unescape(F.replace(role, F.lit("\\c"), F.lit(":"))).alias("role"), _unescape(text).alias("text")
        )

    targets = F.transform("loss", lambda s: _unescape(F.substring(F.col("text"), s["start"] + 1, s["length"])))
    return windows.select(
        "conv_id", "window", F.transform(own, parse).alias("turns"), targets.alias("targets"), F.length("text").alias("chars")
    )


def op9_chat_windows(spark, sf_dir):
    """What can be read back from the formatted windows of every conversation."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    schema = T.StructType.fromDDL("conv_id bigint, turn bigint, role string, text string")
    said = "\\### Assistant: </turn> ok"
    extra = [{"conv_id": -7, "turn": i, "role": r, "text": said} for i, r in enumerate(("user", "assistant"))]
    windows = format_windows(turns.unionByName(small_frame(spark, extra, schema)))
    parts = read_windows(windows)
    own = F.struct("window", "turns", "targets", "chars")
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(own)).alias("w"))
    turns = F.flatten(F.transform("w", lambda w: w["turns"]))
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(F.flatten(F.transform("w", lambda w: w["targets"])), "")
    return whole.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.aggregate("w", F.lit(0).cast("bigint"), lambda a, w: a + w["chars"]).alias("formatted_chars"),
        F.size("w").cast("bigint").alias("n_windows"),
    )


OP9_SQL = r"""
WITH RECURSIVE said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), counted AS (
  SELECT *, row_number() OVER w - 1 AS place, 4 + len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) AS tokens,
         length('### : </turn>' || chr(10))
           + length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\l'), ':', '\c'))
           + length(replace(replace(replace(body, '\', '\b'), '###', '\h'), '</turn>', '\l')) AS chars
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body)
), t AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY place) AS upto,
         CASE WHEN first_value(role) OVER (PARTITION BY conv_id ORDER BY place) = 'system'
              THEN first_value(tokens) OVER (PARTITION BY conv_id ORDER BY place) ELSE 0 END AS lead
  FROM counted
), spans(conv_id, place, since, starts) AS (
  SELECT conv_id, place, CAST(0 AS HUGEINT), TRUE FROM t WHERE place = 0
  UNION ALL
  SELECT t.conv_id, t.place,
         CASE WHEN t.upto - s.since > greatest(1024 - 192 - t.lead, 1) THEN t.upto - t.tokens ELSE s.since END,
         t.upto - s.since > greatest(1024 - 192 - t.lead, 1)
  FROM spans s JOIN t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.place = s.place + 1
), windows AS (
  SELECT s.conv_id, s.place AS first, t.upto - t.tokens AS before,
         CASE WHEN t.lead > 0 AND s.place > 0 THEN 1 ELSE 0 END AS led,
         coalesce(lead(s.place) OVER (PARTITION BY s.conv_id ORDER BY s.place),
                  (SELECT count(*) FROM t c WHERE c.conv_id IS NOT DISTINCT FROM s.conv_id)) AS ends
  FROM spans s JOIN t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.place = s.place WHERE s.starts
), shown AS (
  SELECT w.conv_id, w.first, sum(t.chars) AS chars
  FROM windows w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id
   AND (t.place BETWEEN w.first AND w.ends - 1
        OR (w.led = 1 AND t.place = 0)
        OR (t.place BETWEEN greatest(w.first - 6, w.led) AND w.first - 1 AND w.before - t.upto + t.tokens <= 192))
  GROUP BY ALL
), formatted AS (
  SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars, count(*) AS n_windows FROM shown GROUP BY ALL
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY place)) AS turns_sha256,
         coalesce(string_agg(body, '' ORDER BY place) FILTER (role = 'assistant'), '') AS learned
  FROM t GROUP BY conv_id
)
SELECT whole.conv_id, n_turns, turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       formatted_chars, n_windows
FROM whole JOIN formatted ON whole.conv_id IS NOT DISTINCT FROM formatted.conv_id
"""
