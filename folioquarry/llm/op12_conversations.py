"""Conversation structure repair by a fold over each conversation's turns.

Faults of turns come from windows. What a turn may become depends on its role's initial and its fault alone, so the cheapest
repair is a walk through four states: nothing kept yet, after the system turn, after a user's and after an assistant's. The fold
carries, for each state, the cheapest (cost, edits) that leads there, and takes the least of the structs at each turn; ties go to the
edits that come first by code point, as two walks of equal cost never are the beginning of one another (one more edit would be an insertion, which costs).

Edits are letters: D deletes, I and J insert a user's and an assistant's turn, K keeps, R and S make the turn a user's and an
assistant's. Their order is that of Delete, Insert, Keep, Rerole, and the state decides which of the two letters it is, so
the edits tell the repaired turns without a second search.

Length. Turns are gathered in segments of ``SEGMENT``; one that does not begin the conversation is folded from each of
the four states, and the segments of a conversation are joined like matrices, so no fold grows a text of more than two letters a
turn of a segment. All steps use one shuffle, by conversation. The repaired turns of a conversation are one value, so that a
conversation must fit in one (2 GB).

Defined results. A null role or text counts as one space; a null conversation is a conversation; null turns come first and make no gaps.
Turns of one number are in order of role and text. Conversations of which all turns are dropped have zeros and empty results. Empty tables
give no rows. Columns but ``conv_id``, ``turn``, ``role`` and ``text`` (and ``dropped``, of ``damage``) are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns of a fold.
SEGMENT = 256
BLANK = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
STATES = ("none", "system", "user", "assistant")
#: Above every cost; of states that cannot be reached.
UNREACHED = 1 << 50
LONGEST = (1 << 63) - 1


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): turns damaged by a checksum of conversation and turn; a dropped turn stays as a mark of its conversation."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = (F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20).cast("int")
    text, no, yes = name("text"), F.lit(False), F.lit(True)
    return conversations.select(
        "conv_id", "turn",
        F.when(fate == 4, F.lit("user")).otherwise(name("role")).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(fate == 0, F.array(yes)).when(fate == 3, F.array(no, no)).otherwise(F.array(no))).alias("dropped"),
    )


def faults(turns: DataFrame) -> DataFrame:
    """``turns`` with position, initial, first fault (null, blank, duplicate, truncated), whether the turn before may precede it, and whether its number is new."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), dropped.alias("dropped"), F.substring(role, 1, 1).alias("initial"))
    rows = rows.repartition("conv_id")  # serves the windows and both groupings
    number = F.col("turn").asc_nulls_first()
    order = Window.partitionBy("conv_id", "dropped").orderBy(number, "role", "text")
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(number)
    last = F.substring(F.rtrim("text", F.lit(BLANK)), -1, 1)
    fault = F.when(last == "", "blank").when(F.row_number().over(same) > 1, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    before = F.lag("initial").over(order)
    return rows.select(
        "*", F.row_number().over(order).alias("position"), fault.alias("fault"),
        (before.isNotNull() & ~F.concat(before, "initial").isin("su", "ua", "au")).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.coalesce(F.lag("turn").over(order) == F.col("turn"), F.lit(False))).alias("new_number"),
    )


def _walk(cost: Column | int, edits: Column | str) -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(as_column(cost).cast("bigint").alias("cost"), as_column(edits).alias("edits"))


def _then(walk: Column, cost: Column | int, edit: str) -> Column:
    return _walk(walk["cost"] + cost, F.concat(walk["edits"], F.lit(edit)))


def _states(*walks: Column) -> Column:
    return F.struct(*(w.alias(s) for w, s in zip(walks, STATES, strict=True)))


def _with_insertions(none: Column, system: Column, user: Column, assistant: Column) -> Column:
    user = F.least(user, _then(F.least(none, system, assistant), INSERT, "I"))
    return _states(none, system, user, F.least(assistant, _then(user, INSERT, "J")))


def _begin(state: str) -> Column:
    return _states(*(_walk(0 if s == state else UNREACHED, "") for s in STATES))


def _turn(walks: Column, turn: Column) -> Column:
    """The cheapest walks after one more turn, and the insertions that may follow it."""
    none, system, user, assistant = (walks[s] for s in STATES)
    must_go = turn["fault"].isin("blank", "duplicate")
    more = F.when(must_go, UNREACHED).when(turn["fault"] == "truncated", TRUNCATED).otherwise(0).cast("bigint")
    kept = lambda initial: F.when(turn["initial"] == initial, more + KEEP).otherwise(UNREACHED)
    open_ = F.least(none, system, assistant)
    return _with_insertions(
        _then(none, DELETE, "D"),
        F.least(_then(system, DELETE, "D"), _then(none, kept("s"), "K")),
        F.least(_then(user, DELETE, "D"), _then(open_, kept("u"), "K"), _then(open_, more + REROLE, "R")),
        F.least(_then(assistant, DELETE, "D"), _then(user, kept("a"), "K"), _then(user, more + REROLE, "S")),
    )


def _folded(turns: Column, begin: Column) -> Column:
    return F.aggregate(turns, begin, _turn)


def _joined(walks: Column, part: Column) -> Column:
    """The walks through a further segment, folded from each state."""
    after = lambda to: F.least(*(_walk(walks[s]["cost"] + part["folds"][i][to]["cost"], F.concat(walks[s]["edits"], part["folds"][i][to]["edits"])) for i, s in enumerate(STATES)))
    return F.when(part["segment"] == 0, part["folds"][0]).otherwise(_states(*(after(s) for s in STATES)))


def _inserted(edits: Column) -> Column:
    return F.transform(F.filter(F.split(edits, ""), lambda c: c != ""), lambda c: F.struct(F.when(c == "I", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")))


def _edited(turn: Column, edits: Column) -> Column:
    """The repaired turns that a turn and the insertions before it become."""
    what = F.substring(edits, -1, 1)
    role = F.when(what == "R", "user").when(what == "S", "assistant").otherwise(turn["role"])
    own = F.filter(F.array(F.struct(role.alias("role"), turn["text"].alias("text"))), lambda _: what != "D")
    return F.concat(_inserted(F.substring(edits, F.lit(1), F.length(edits) - 1)), own)


def repair(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, turns): a row for each conversation, ``turns`` being the repaired ones.

    Rows whose column ``dropped`` is true, if there is one, only name their conversation.
    """
    rows = faults(turns).withColumn("segment", F.floor((F.col("position") - 1) / SEGMENT) * F.when(F.col("dropped"), 0).otherwise(1))
    there = ~F.col("dropped")
    count = lambda c: F.count_if(there & F.coalesce(c, F.lit(False)))
    wide = F.col("turn").cast("decimal(38,0)")
    parts = rows.groupBy("conv_id", "segment").agg(
        F.array_sort(F.collect_list(F.when(there, F.struct("position", "initial", "fault", "role", "text")))).alias("turns"),
        *(count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
        count(F.col("illegal")).alias("illegal"), count(F.col("new_number")).alias("numbers"),
        F.max(F.when(there, wide)).alias("high"), F.min(F.when(there, wide)).alias("low"),
    )
    whole = _folded(F.col("turns"), _with_insertions(*(_walk(0 if s == "none" else UNREACHED, "") for s in STATES)))
    folds = F.when(F.col("segment") == 0, F.array(whole)).otherwise(F.array(*(_folded(F.col("turns"), _begin(s)) for s in STATES)))
    counts = ("blank", "duplicate", "truncated", "illegal")
    each = parts.withColumn("folds", folds).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("segment", "folds", "turns"))).alias("parts"),
        *(F.sum(c).alias(c) for c in (*counts, "numbers")), F.max("high").alias("high"), F.min("low").alias("low"),
    )
    each = each.withColumn("walks", F.aggregate("parts", _begin("none"), _joined)).withColumn("best", F.least("walks.none", "walks.assistant"))
    each = each.withColumn("turns", F.flatten(F.transform("parts", lambda p: p["turns"])))
    each = each.withColumn("edits", F.regexp_extract_all("best.edits", F.lit("[IJ]*[DKRS]"), F.lit(0)))
    repaired = F.concat(
        F.flatten(F.transform("turns", lambda t, i: _edited(t, F.get("edits", i)))), _inserted(F.regexp_extract("best.edits", "[IJ]*$", 0))
    )
    gaps = F.least(F.coalesce(F.col("high") - F.col("low") + 1 - F.col("numbers"), F.lit(0)), F.lit(LONGEST)).cast("bigint")
    return each.select("conv_id", gaps.alias("gaps"), *counts, F.col("best.cost").alias("cost"), F.translate("best.edits", "JS", "IR").alias("audit"), repaired.alias("turns"))


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """The repair of damaged conversations, with the digest of the repaired turns."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return repair(damage(conversations)).withColumn("repaired_sha256", F.sha2(lines, 256)).drop("turns")
