"""Chat formatting by quotation linking, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import materialised, text_column
from lakegate.operators.ordering import with_row_number

# Fixed values.
QUOTE = r"^(?:[ \t]*>)+"  # markers of a quoted line; their number is its level
TEMPLATE = ("<|", "|>\n", "\n<|end|>\n")  # before the role, before the text, after it
_CUT, _LEVEL = "\u0001", "\u0002"


def passages(text: Column) -> Column:
    """Passages as structs (level, body, norm): runs of neighbouring lines of one quote level, cut at blank lines.

    ``body`` keeps the lines without their markers; ``norm`` is it in lower case with single blanks.
    """
    clean = F.regexp_replace(text, r"[\x00-\x08\x0B-\x1F]", "")
    parts = F.transform(
        F.split(clean, "\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, QUOTE + r"[ \t]?", "").alias("body"),
        ),
    )

    def joined(lines: Column) -> Column:
        def one(line: Column, i: Column) -> Column:
            before = F.get(lines, i - 1)
            follows = (i > 0) & (before["level"] == line["level"]) & (F.trim(before["body"]) != "")
            start = F.concat(F.lit(_CUT), line["level"].cast("string"), F.lit(_LEVEL), line["body"])
            return (
                F.when(F.trim(line["body"]) == "", F.lit(""))
                .when(follows, F.concat(F.lit("\n"), line["body"]))
                .otherwise(start)
            )

        # A blank line leaves nothing, and the line after it starts a passage.
        return F.filter(F.split(F.array_join(F.transform(lines, one), ""), _CUT), lambda p: p != "")

    bound = F.get(F.transform(F.array(parts), joined), F.lit(0))

    def cut(p: Column) -> Column:
        body = F.substring_index(p, _LEVEL, -1)
        return F.struct(
            F.substring_index(p, _LEVEL, 1).cast("int").alias("level"),
            body.alias("body"),
            F.trim(F.regexp_replace(F.lower(body), r"\s+", " ")).alias("norm"),
        )

    return F.transform(bound, cut)


def linked(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``messages``: conv_id, turn, role, body, n_quoted, n_linked, parent, root, depth, row.

    Quoted passages are normalised and hashed, and meet the earliest message of the conversation that wrote the same
    passage itself (level 0) before. ``parent`` is the latest such message among the passages of the lowest level that
    has any: a reply quotes what it answers at level 1, and what that quoted at deeper ones. ``root`` is where following
    the parents ends, ``body`` the text without quoted lines, passages set apart by a blank line.

    A conversation and turn name a message; rows that share them share their links. Messages with null turns and those
    that quote nothing known are roots of their own. Null conversations are one conversation; null texts are empty;
    repeated rows stay; an empty table gives an empty one; other columns are not read. Passages are reduced to their
    earliest place before they are joined, so the join makes no row more, and a common passage or a large conversation
    spreads over its hashes and turns.
    """
    rows = messages.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        passages(text_column(text_col)).alias("passages"),
    ).select("*", F.monotonically_increasing_id().alias("row"))
    rows = materialised(rows, "messages")
    each = rows.where("turn is not null").select("conv_id", "turn", F.explode("passages").alias("p"))
    each = each.select(
        "conv_id",
        "turn",
        F.col("p.level").alias("level"),
        F.xxhash64("p.norm").alias("h1"),
        F.xxhash64(F.lit(1), "p.norm").alias("h2"),
    )
    quoted = each.where("level > 0").distinct()
    own = each.where("level = 0").groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("original"))
    q, o = quoted.alias("q"), own.alias("o")
    same = F.col("q.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("q.h1") == F.col("o.h1")) & (F.col("q.h2") == F.col("o.h2"))
    found = q.join(o, same).where("o.original < q.turn").groupBy("q.conv_id", "q.turn", "q.level")
    by_level = found.agg(F.count(F.lit(1)).alias("n"), F.max("o.original").alias("original"))
    links = by_level.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_linked"), F.min_by("original", "level").alias("parent")
    )
    links = materialised(links, "links")
    roots = _roots(links.select("conv_id", "turn", "parent"))
    known = links.join(roots.select("conv_id", "turn", "root", "depth"), _same_message(links, roots)).select(
        links["conv_id"].alias("_conv"), links["turn"].alias("_turn"), "n_linked", "parent", "root", "depth"
    )
    out = rows.join(known, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left")
    mine = F.filter("passages", lambda p: p["level"] == 0)
    return out.select(
        "conv_id",
        "turn",
        "role",
        F.array_join(F.transform(mine, lambda p: p["body"]), "\n\n").alias("body"),
        (F.size("passages") - F.size(mine)).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "parent",
        F.coalesce("root", "turn").alias("root"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        "row",
    )


def _same_message(a: DataFrame, b: DataFrame) -> Column:
    return a["conv_id"].eqNullSafe(b["conv_id"]) & (a["turn"] == b["turn"])


def _roots(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) by pointer jumping: rounds grow with the logarithm of the longest chain.

    A parent's turn is smaller than its reply's, so there is no cycle.
    """
    now = materialised(parents.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).alias("depth")), "roots")
    while True:
        up = now.select(
            F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("root").alias("_root"), F.col("depth").alias("_depth")
        )
        moved = now.join(up, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("root") == F.col("_turn")), "left")
        now = materialised(
            moved.select(
                "conv_id",
                "turn",
                F.coalesce("_root", "root").alias("root"),
                (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
                F.col("_root").isNotNull().alias("moved"),
            ),
            "roots",
        )
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def conversations(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block_size: int = 256,
) -> DataFrame:
    """(conv_id, block, n_messages, n_quoted, n_linked, turns, parents, chat): conversations in reply order, no quotes.

    Messages are ordered by thread, the thread's root first, then by turn, so each reply comes after what it answers;
    rows of one turn go by role and text. A conversation comes in blocks of ``block_size`` messages: one row as a rule,
    more for longer ones, so that no task ever holds a whole large conversation. ``chat`` is the block's formatted text.
    See :func:`linked` for nulls and repeated rows; null turns come last.
    """
    found = linked(messages, conv_col, turn_col, role_col, text_col)
    keyed = found.select(
        "*",
        F.col("conv_id").isNull().alias("z_conv"),
        F.col("root").isNull().alias("z_root"),
        F.coalesce("role", F.lit("")).alias("z_role"),
        F.xxhash64("body").alias("z_body"),
    )
    order = ["z_conv", "conv_id", "z_root", "root", "turn", "z_role", "z_body", "row"]
    numbered = materialised(with_row_number(keyed, order, "place"), "ordered")
    first = numbered.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("place").alias("first"))
    placed = numbered.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")))
    offset = F.col("place") - F.col("first")
    before, middle, after = TEMPLATE
    said = F.concat(F.lit(before), F.coalesce("role", F.lit("unknown")), F.lit(middle), F.col("body"), F.lit(after))
    blocks = placed.groupBy("conv_id", F.floor(offset / block_size).cast("int").alias("block")).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum("n_quoted").cast("long").alias("n_quoted"),
        F.sum("n_linked").alias("n_linked"),
        F.sort_array(F.collect_list(F.struct("place", "turn", "parent", said.alias("said")))).alias("m"),
    )
    return blocks.select(
        "conv_id",
        "block",
        "n_messages",
        "n_quoted",
        "n_linked",
        F.transform("m", lambda m: m["turn"]).alias("turns"),
        F.transform("m", lambda m: m["parent"]).alias("parents"),
        F.array_join(F.transform("m", lambda m: m["said"]), "").alias("chat"),
    )
