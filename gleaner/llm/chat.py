"""Chat formatting in budgeted windows (operator 8): DataFrame functions only.

A conversation's turns are laid out by prefix sums of their tokens. With the leading system turn set aside, a turn of more
than a third of the budget has a window of its own; the others share windows of the turns whose prefix sums begin in the
same two thirds of a budget. A window's own turns thus fit the budget, and windows are aligned to turns without a
sequential pass. A window holds the system turn, up to `history` turns repeated from before as far as what is left of
the budget goes, and its own turns; the loss mask covers the assistant turns that are its own, so each is learned once.

A turn is written as <|im_start|>role newline text <|im_end|> newline. Inside roles and texts `&` becomes `&amp;` and
`<|` becomes `&lt;|` (in roles also a newline `&#10;`), which can be undone and leaves no control string.

Turns are never cut or dropped: only a turn that with the system turn is over the budget makes its window longer.

Edge cases: null roles and texts are empty; rows without a conversation id are one conversation with a null id; rows of
one turn number follow each other by role and text; an empty table gives no rows; a very long text is one turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY = 1024, 2
#: Tokens that the template adds to a turn.
TURN_TOKENS = 5
START, END = "<|im_start|>", "<|im_end|>"
#: What counts as one token: a run of letters, a digit, or another character that isn't white space.
TOKEN = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]"


def escape(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _role_out(x: Column) -> Column:
    return F.replace(escape(x), F.lit("\n"), F.lit("&#10;"))


def _role_in(x: Column) -> Column:
    return unescape(F.replace(x, F.lit("&#10;"), F.lit("\n")))


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, formatted, repeated (leading turns that earlier windows have too), loss (spans of code points)."""
    text, role = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(role_col), F.lit(""))
    rows = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)) + TURN_TOKENS)
    rows = rows.withColumn("piece", F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END + "\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    # One pass over a conversation's sorted turns gives all that follows.
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One exchange and one sort of a conversation's turns give all that follows.
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("first", F.first(F.struct("role", "piece", "tokens")).over(order))
    rows = rows.withColumn("past", F.collect_list(F.struct("n", "piece", "tokens")).over(order.rowsBetween(-history, -1)))
    system = F.col("first.role") == "system"
    rows = rows.withColumn("space", F.greatest(F.lit(1), F.lit(budget) - F.when(system, F.col("first.tokens")).otherwise(0)))
    rows = rows.withColumn("cost", F.when(system & (F.col("n") == 1), 0).otherwise(F.col("tokens")).cast("bigint")).withColumn("system", system)
    rows = rows.withColumn("before", F.coalesce(F.sum("cost").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("long", F.col("cost") * 3 > F.col("space"))
    # Long turns stand alone; between them the sums begin anew.
    rows = rows.withColumn("edge", F.col("long") | F.lag("long", 1, True).over(order))
    rows = rows.withColumn("place", F.floor((F.col("before") - F.max(F.when(F.col("edge"), F.col("before"))).over(so_far)) * 3 / (F.col("space") * 2)))
    rows = rows.withColumn("fresh", F.col("edge") | (F.col("place") != F.lag("place").over(order)))
    rows = rows.withColumn("window", (F.sum(F.col("fresh").cast("int")).over(so_far) - 1).cast("int"))
    own = rows.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("n", "piece", "role"))).alias("own"),
        F.min(F.struct("n", "past")).alias("open"),
        F.sum("cost").alias("cost"),
        F.first("space").alias("space"),
        F.first("system").alias("system"),
        F.first("first").alias("first"),
    )
    later = F.col("open.n") > 1
    pieces = F.array().cast("array<string>")

    def back(acc: Column, p: Column) -> Column:
        """The turn before what is taken already, unless a nearer one was too long or it is the system turn."""
        fits = (p["tokens"] <= acc["left"]) & ~(F.col("system") & (p["n"] == 1))
        return F.when(fits, F.struct((acc["left"] - p["tokens"]).alias("left"), F.concat(F.array(p["piece"]), acc["out"]).alias("out"))).otherwise(F.struct(F.lit(-1).cast("bigint").alias("left"), acc["out"].alias("out")))

    repeat = F.aggregate(F.reverse("open.past"), F.struct((F.col("space") - F.col("cost")).alias("left"), pieces.alias("out")), back)["out"]
    head = F.when(F.col("system") & later, F.array("first.piece")).otherwise(pieces)
    own = own.withColumn("lead", F.concat(head, F.when(later, repeat).otherwise(pieces)))
    lead_chars = F.length(F.array_join("lead", ""))
    # Where each own turn begins, by a running sum over the window's few turns.
    state = F.struct(lead_chars.cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("loss"))

    def step(acc: Column, t: Column) -> Column:
        prefix = F.length(F.regexp_extract(t["piece"], r"^[^\n]*\n", 0))
        span = F.struct((acc["at"] + prefix).cast("bigint").alias("start"), (F.length(t["piece"]) - prefix - len(END) - 1).cast("bigint").alias("length"))
        return F.struct((acc["at"] + F.length(t["piece"])).cast("bigint").alias("at"), F.when(t["role"] == "assistant", F.array_append(acc["loss"], span)).otherwise(acc["loss"]).alias("loss"))

    formatted = F.concat(F.array_join("lead", ""), F.array_join(F.transform("own", lambda t: t["piece"]), ""))
    return own.select("conv_id", "window", formatted.alias("formatted"), F.size("lead").alias("repeated"), F.aggregate("own", state, step)["loss"].alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, window, turns (role and text of the turns that are the window's own), loss (the masked text, unescaped), chars: all from the formatted text."""
    parts = F.slice(F.split("formatted", r"<\|im_start\|>", -1), F.col("repeated") + 2, F.greatest(F.lit(1), F.length("formatted")))

    def turn(p: Column) -> Column:
        head = F.length(F.regexp_extract(p, r"^[^\n]*\n", 0))
        return F.struct(_role_in(F.substring(p, F.lit(1), head - 1)).alias("role"), unescape(F.substring(p, head + 1, F.length(p) - head - len(END) - 1)).alias("text"))

    masked = F.array_join(F.transform("loss", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return windows.select("conv_id", "window", F.transform(parts, turn).alias("turns"), masked.alias("loss"), F.length("formatted").alias("chars"))
