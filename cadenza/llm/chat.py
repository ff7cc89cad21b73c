"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens choose spans of whole turns.  A window starts with the conversation's first system turn (if that came before it), then
repeats turns of the window before it that end within ``history`` tokens of its start, then has its own turns, as many as
still fit: a turn that would take the window over ``budget`` opens the next one.  If the history would leave no room for the turn that opens a
window, that window repeats none.  So no window is over budget, unless its only own turn doesn't fit beside the system turn;
such a window is marked ``over_budget``.  The loss mask covers the texts of its own assistant turns only, so each target is
learned once; repeated turns are context.

What is left of the room depends on where the window began, which is a fold over the turns before.  It runs once a conversation, on an array of three numbers a turn (no texts),
and gives the turns that open a window, which are joined back.  The fold goes by runs of ``RUN`` turns and keeps a list a run, so what it copies stays in proportion to the turns;
runs change no window.

Template: ``<s>`` role newline text ``</s>`` for each turn.  Inside roles and texts ``&``, ``<`` and ``[`` are
written ``&amp;``, ``&lt;`` and ``&lb;`` (and a newline in a role ``&nl;``), so control strings occur nowhere but as marks,
and reading back is exact.

Turns are ordered by turn number (null first), then role and text; repeated rows are turns of their own.  Null roles
and texts are empty.  A null conversation id is a conversation of its own.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY, RUN = 1024, 256, 512
#: What stands for each character inside a turn, in the order of writing.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
OPEN, CLOSE = "<s>", "</s>"


def escape(value: Column) -> Column:
    for plain, coded in ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(coded))
    return value


def unescape(value: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        value = F.replace(value, F.lit(coded), F.lit(plain))
    return value


def escape_role(value: Column) -> Column:
    return F.replace(escape(value), F.lit("\n"), F.lit("&nl;"))


def unescape_role(value: Column) -> Column:
    return unescape(F.replace(value, F.lit("&nl;"), F.lit("\n")))


def turn_tokens(formatted: Column) -> Column:
    """An estimate in whole tokens of a turn as it is written: four UTF-8 bytes each."""
    return F.ceil(F.octet_length(formatted) / 4).cast("long")


def window_starts(rows: DataFrame) -> DataFrame:
    """conv and ord of the turns that open a window, with opens = 1; ``rows``: conv, ord, n and room (what a window that this turn opens has room for) of every turn."""
    long = lambda v: F.lit(v).cast("long")

    def place(held: Column, x: Column) -> Column:
        fits = held["used"] + x["n"] <= held["room"]
        used, room = F.when(fits, held["used"] + x["n"]).otherwise(x["n"]), F.when(fits, held["room"]).otherwise(x["room"])
        return F.struct(used.alias("used"), room.alias("room"), F.when(fits, held["starts"]).otherwise(F.concat(held["starts"], F.array(x["ord"]))).alias("starts"))

    def run(held: Column, turns: Column) -> Column:
        got = F.aggregate(turns, F.struct(held["used"].alias("used"), held["room"].alias("room"), F.array().cast("array<long>").alias("starts")), place)
        return F.struct(got["used"].alias("used"), got["room"].alias("room"), F.concat(held["runs"], F.array(got["starts"])).alias("runs"))

    sizes = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(F.col("ord").cast("long").alias("ord"), F.col("n").cast("long").alias("n"), F.col("room").cast("long").alias("room")))).alias("turns"))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("turns") - 1) / RUN).cast("int")), lambda k: F.slice("turns", k * RUN + 1, RUN))
    nothing = F.struct(long(1).alias("used"), long(0).alias("room"), F.array().cast("array<array<long>>").alias("runs"))  # full, so the first turn opens a window
    return sizes.select("conv", F.explode(F.flatten(F.aggregate(runs, nothing, run)["runs"])).alias("ord"), F.lit(1).alias("opens"))


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=turn_tokens) -> DataFrame:
    """conv_id, window_no, formatted, n_context (turns repeated at the start, of which the system turn is the first if there is one), loss_spans (start,
    length in code points of ``formatted``, in order), n_tokens (by ``tokens``, a function of a written turn) and over_budget."""
    rows = turns.select("conv_id", F.struct("conv_id").alias("conv"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("piece", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(CLOSE))).withColumn("n", tokens(F.col("piece")))
    whole = Window.partitionBy("conv_id")
    ordered = whole.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    is_system = F.col("role") == "system"
    rows = rows.withColumns({"ord": F.row_number().over(ordered), "of_system": F.sum(is_system.cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.withColumn("system", is_system & (F.col("of_system") == 1))
    by_ord = whole.orderBy("ord")
    before = by_ord.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"starts": F.coalesce(F.sum(F.when(F.col("system"), 0).otherwise(F.col("n"))).over(before), F.lit(0)), "fixed": F.coalesce(F.sum(F.when(F.col("system"), F.col("n"))).over(before), F.lit(0))})
    near = F.min(F.when(~F.col("system"), F.col("starts"))).over(whole.orderBy("starts").rangeBetween(-history, 0))  # where turns begin that end within ``history``
    rows = rows.withColumn("past", F.coalesce(F.col("starts") - near, F.lit(0)))
    rows = rows.withColumn("repeats", F.col("fixed") + F.col("past") + F.col("n") <= budget)
    rows = rows.withColumn("room", F.lit(budget) - F.col("fixed") - F.when(F.col("repeats"), F.col("past")).otherwise(0))
    rows = rows.join(window_starts(rows), ["conv", "ord"], "left").withColumn("opens", F.coalesce("opens", F.lit(0)))
    rows = rows.withColumn("window_no", F.sum("opens").over(by_ord.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    by_window = whole.orderBy("window_no")
    rows = rows.withColumns({
        "last_no": F.max("window_no").over(whole), "closes": F.max(F.col("starts") + F.when(F.col("system"), 0).otherwise(F.col("n"))).over(Window.partitionBy("conv_id", "window_no")),
        "next_repeats": F.max(F.when(F.col("opens") == 1, F.col("repeats"))).over(by_window.rangeBetween(1, 1)),
    })
    later = F.when(F.col("window_no") < F.col("last_no"), F.sequence(F.col("window_no") + 1, F.col("last_no")))
    again = (
        F.when(F.col("system"), F.transform(later, lambda w: F.struct(w.alias("no"), F.lit(0).alias("kind"))))
        .when(F.col("next_repeats") & (F.col("closes") - F.col("starts") <= history), F.array(F.struct((F.col("window_no") + 1).alias("no"), F.lit(1).alias("kind"))))
    )
    places = F.concat(F.array(F.struct(F.col("window_no").alias("no"), F.lit(2).alias("kind"))), F.coalesce(again, F.array()))
    rows = rows.select("conv_id", "ord", "piece", "n", F.char_length(escape(F.col("text"))).alias("text_chars"), (F.col("role") == "assistant").alias("target"), F.explode(places).alias("place"))
    rows = rows.select("conv_id", F.col("place.no").alias("window_no"), F.col("place.kind").alias("kind"), "ord", "piece", "n", "text_chars", "target")
    inside = Window.partitionBy("conv_id", "window_no").orderBy("kind", "ord").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("to", F.sum(F.char_length("piece")).over(inside))
    start = F.col("to") - F.col("text_chars") - len(CLOSE)
    rows = rows.withColumn("span", F.when(F.col("target") & (F.col("kind") == 2), F.struct(start.cast("int").alias("start"), F.col("text_chars").alias("length"))))
    made = rows.groupBy("conv_id", "window_no").agg(F.array_sort(F.collect_list(F.struct("to", "kind", "piece"))).alias("pieces"), F.array_sort(F.collect_list("span")).alias("loss_spans"), F.sum("n").alias("n_tokens"))
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return made.select("conv_id", "window_no", text.alias("formatted"), F.size(F.filter("pieces", lambda p: p["kind"] < 2)).alias("n_context"), "loss_spans", "n_tokens", (F.col("n_tokens") > budget).alias("over_budget"))


def read_turns(formatted: Column, n_context: Column) -> Column:
    """Array of (role, text), unescaped, of a window's own turns."""
    parts = F.split(formatted, CLOSE)
    own = F.slice(parts, n_context + 1, F.size(parts) - 1 - n_context)
    head = lambda p: F.instr(p, "\n")
    return F.transform(own, lambda p: F.struct(unescape_role(F.substring(p, F.lit(len(OPEN) + 1), head(p) - len(OPEN) - 1)).alias("role"), unescape(F.substr(p, head(p) + 1)).alias("text")))


def read_losses(formatted: Column, spans: Column) -> Column:
    """Array of the unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"])))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from formatted windows."""
    read = windows.select("conv_id", "window_no", F.char_length("formatted").alias("chars"), read_turns(F.col("formatted"), F.col("n_context")).alias("turns"), read_losses(F.col("formatted"), F.col("loss_spans")).alias("losses"))
    texts = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = read.select("conv_id", "window_no", "chars", F.size("turns").alias("n"), F.array_join(texts, "").alias("turns"), F.array_join("losses", "").alias("losses"))
    per = read.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("window_no", "turns", "losses"))).alias("w"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    turns = F.array_join(F.transform("w", lambda x: x["turns"]), "")
    losses = F.array_join(F.transform("w", lambda x: x["losses"]), "")
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return per.select("conv_id", "n_turns", sha(turns).alias("turns_sha256"), F.char_length(losses).cast("long").alias("loss_chars"), sha(losses).alias("loss_sha256"), F.col("formatted_chars"))
