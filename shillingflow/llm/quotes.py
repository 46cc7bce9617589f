"""Conversations in reply order from messages that quote each other.

Quoted lines begin with ``>`` marks, one per level of nesting. A run of lines of one level is a
passage. Passages are normalised (case, white space), hashed, and joined to the first message of
the conversation that wrote those words itself: as a whole text, paragraph or line, else as runs of
words, which also meet a quote that was cut out of a line or wrapped anew. That message is what the
quoting one replies to; quotes and the lines that announce them are left out of the text.

Everything is column expressions, joins and grouped aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_out
from .common import same, with_running

MARKS = r"^[ \t]*>[> \t]*"
#: Lines that announce a quote, in the languages of the tables; fixed values.
ANNOUNCED = (
    r"^On .+ wrote:$",
    r"^Am .+ schrieb.*:$",
    r"^Le .+ a écrit ?:$",
    r"^El .+ escribió:$",
)
QUOTES = r"(?m)^[ \t]*>"
RUN, LEAST_RUN = 5, 3  # words of a run; a passage of fewer words is one run, below LEAST_RUN it has none


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\x{A0}]+", " "))


def _words(text: Column) -> Column:
    """Letters and digits only, so marks at a cut do not matter."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda x: x != "")


def _run_keys(words: Column, length: Column) -> Column:
    """Hashes of all runs of ``length`` words. The words are bound once, not computed again for every run."""
    def runs(held: Column) -> Column:
        starts = F.when(F.size(held) >= length, F.sequence(F.lit(1), F.size(held) - length + 1)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.slice(held, i, length))))
    return F.flatten(F.transform(F.array(words), runs))


def _lines(text: Column) -> Column:
    """Lines as (level, body): the number of leading marks, and what follows them."""
    def one(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
        return F.struct(level.alias("level"), F.substring(line, F.length(marks) + 1, F.length(line)).alias("body"))
    return F.transform(F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n"), one)


def _announces(body: Column) -> Column:
    hit = F.lit(False)
    for pattern in ANNOUNCED:
        hit = hit | F.trim(body).rlike(pattern)
    return hit


def parsed(messages: DataFrame) -> DataFrame:
    """Adds ``quoting`` and ``content``, the text without quotes and without the lines that announce one.

    A text that quotes nothing stays as it is; a null text is empty."""
    lined = messages.withColumn("_lines", _lines(F.col("text")))
    following = lambda i: F.coalesce(F.try_element_at("_lines", i + 2)["level"], F.lit(0))
    own = F.transform("_lines", lambda x, i: F.when((x["level"] == 0) & ~(_announces(x["body"]) & (following(i) > 0)), x["body"]))
    text = F.trim(F.regexp_replace(F.array_join(own, "\n"), r"\n\s*\n", "\n\n"))
    quoting = F.coalesce(F.col("text").rlike(QUOTES), F.lit(False))
    return lined.withColumn("quoting", quoting).withColumn(
        "content", F.when(quoting, F.regexp_replace(text, r"^\s+|\s+$", "")).otherwise(F.coalesce("text", F.lit("")))).drop("_lines")


def passages(quoting: DataFrame) -> DataFrame:
    """The quoted passages that hold words, with their level and number and the keys of the passage, its lines
    and its runs of ``run`` words (0: too short for one).

    A passage ends where the level changes; its blank lines belong to it but have no key of their own.
    Windows and lists reach over one message only."""
    ids = ["conv_id", "turn", "text_hash"]
    lines = quoting.withColumn("text_hash", F.xxhash64("text")).select(*ids, F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    lines = lines.select(*ids, "at", "line.level", "line.body")
    order = Window.partitionBy(*ids).orderBy("at")
    starts = F.when(F.col("level") == F.lag("level").over(order), 0).otherwise(1)
    lines = lines.withColumn("starts", starts).withColumn("number", F.sum("starts").over(order)).filter("level > 0")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), " ")
    grouped = lines.groupBy(*ids, "number", "level").agg(whole.alias("whole"), F.collect_list("body").alias("bodies"))
    keys = F.array_distinct(F.filter(F.transform("bodies", _normal), lambda x: x != ""))
    grouped = grouped.withColumn("words", _words(F.col("whole"))).withColumn("whole", _normal(F.col("whole"))).filter("whole <> ''")
    run = F.when(F.size("words") < LEAST_RUN, 0).otherwise(F.least(F.size("words"), F.lit(RUN)))
    return grouped.select(
        *ids, "number", "level", F.xxhash64("whole").alias("whole_key"), F.transform(keys, lambda x: F.xxhash64(x)).alias("line_keys"),
        run.alias("run"), F.when(run > 0, _run_keys(F.col("words"), run)).otherwise(F.array().cast("array<bigint>")).alias("run_keys"))


def first_writers(contents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The first message of a conversation that holds a wanted key as one of its own lines, its
    paragraphs or its whole text. The aggregate takes copies and common lines before any join."""
    text = F.col("content")
    pieces = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, r"\n\s*\n"), F.array(text)))
    keyed = contents.select("conv_id", "turn", F.explode(F.transform(F.filter(F.transform(pieces, _normal), lambda x: x != ""), lambda x: F.xxhash64(x))).alias("key"))
    held = keyed.join(wanted, ["conv_id", "key"], "left_semi")
    return held.groupBy("conv_id", "key").agg(F.min("turn").alias("writer"))


def run_writers(contents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The first message of a conversation that holds a wanted run of words (``conv_id, run, key``). Only conversations
    that ask for runs are read, and only runs of the lengths that they ask for."""
    lengths = wanted.groupBy("conv_id").agg(F.collect_set("run").alias("lengths"))  # at most RUN - LEAST_RUN + 1 values
    asked = contents.join(lengths, "conv_id").select("conv_id", "turn", "lengths", _words(F.col("content")).alias("words"))
    keyed = asked.select("conv_id", "turn", "words", F.explode("lengths").alias("run")).select(
        "conv_id", "turn", F.explode(_run_keys(F.col("words"), F.col("run"))).alias("key"))
    held = keyed.join(wanted.select("conv_id", "key"), ["conv_id", "key"], "left_semi")
    return held.groupBy("conv_id", "key").agg(F.min("turn").alias("writer"))


def links(quoted: DataFrame, contents: DataFrame) -> DataFrame:
    """Per passage the message that wrote it: the first that holds the whole passage; else the one by which all its
    runs of words had been written, counting each from its first writer; else the latest first writer of its lines;
    else that of its runs, if at least half of them were written before. No pairs of messages are made."""
    ids = ["conv_id", "turn", "text_hash", "number", "level"]
    keyed = quoted.select(*ids, F.explode(F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("whole_key").alias("key"))), F.transform(
        "line_keys", lambda k: F.struct(F.lit(False).alias("whole"), k.alias("key"))))).alias("k")).select(*ids, "k.whole", "k.key")
    writers = first_writers(contents, keyed.select("conv_id", "key").distinct())
    met = keyed.join(writers, ["conv_id", "key"]).filter("writer < turn")
    plain = met.groupBy(*ids).agg(F.max(F.when(F.col("whole"), F.col("writer"))).alias("whole"), F.max("writer").alias("line"))

    found = quoted.join(plain.select(*ids, "whole", "line"), ids, "left")
    open_ = write_out(found.filter("whole is null"), "open-passages")
    runs = open_.filter("run > 0").select(*ids, "run", F.size("run_keys").alias("n"), F.explode("run_keys").alias("key"))
    by_run = run_writers(contents, runs.select("conv_id", "run", "key").distinct())
    known = runs.join(by_run, ["conv_id", "key"]).filter("writer < turn").groupBy(*ids).agg(
        F.max("writer").alias("run_writer"), F.count(F.lit(1)).alias("held"), F.max("n").alias("n"))
    rest = open_.join(known, ids, "left").select(*ids, F.coalesce(
        F.when(F.col("held") == F.col("n"), F.col("run_writer")), F.col("line"),
        F.when(2 * F.col("held") >= F.col("n"), F.col("run_writer"))).alias("writer"))
    return found.filter("whole is not null").select(*ids, F.col("whole").alias("writer")).unionByName(rest.filter("writer is not null"))


def replies(linked: DataFrame) -> DataFrame:
    """The message that a message replies to: the writer of its outermost linked quote, the latest if several."""
    best = F.max(F.struct((-F.col("level")).alias("near"), F.col("writer")))
    return linked.groupBy("conv_id", "turn").agg(best["writer"].alias("reply_turn"))


def threads(parents: DataFrame) -> DataFrame:
    """Root and depth of every replying message, by doubling: after n rounds a pointer spans 2^n replies."""
    now = write_out(parents.select("conv_id", "turn", "reply_turn", F.col("reply_turn").alias("root"), F.lit(1).alias("depth")), "threads")
    while True:
        up = now.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("root").alias("up_root"), F.col("depth").alias("up_depth"))
        met = now.join(up, (now["conv_id"] == up["c"]) & (now["root"] == up["t"]), "left")
        after = write_out(met.select("conv_id", "turn", "reply_turn", F.coalesce("up_root", "root").alias("root"),
                                     (F.col("depth") + F.coalesce("up_depth", F.lit(0))).alias("depth"),
                                     F.col("up_root").isNotNull().alias("moved")), "threads")
        if after.filter("moved").isEmpty():
            return after.select("conv_id", "turn", "reply_turn", "root", "depth")
        now = after.drop("moved")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Adds to every message: ``n_quoted`` and ``n_linked`` passages, ``reply_turn``, ``thread_turn`` (root of
    its thread), ``depth``, ``position`` in its conversation, ``content`` and ``chat`` (content with its role).

    Conversations are ordered by thread, then depth, then turn, so an answer follows what it answers.
    Messages with null ids or turns link to nothing (they come first); repeated rows are linked alike and
    placed one after another; a quote that nobody wrote counts as unlinked; columns of these names are
    replaced and all others stay. An empty table gives an empty one.
    """
    added = ["n_quoted", "n_linked", "reply_turn", "thread_turn", "depth", "position", "content", "chat"]
    used = ["conv_id", "turn", "role", "text"]
    others = [c for c in messages.columns if c not in used + added]
    rest = F.struct(*[F.col(c) for c in others]) if others else F.lit(None).cast("boolean")
    rows = parsed(messages.select(*used, rest.alias("rest"))).withColumn("text_hash", F.xxhash64("text"))
    quoting = rows.filter("quoting and conv_id is not null and turn is not null").select("conv_id", "turn", "text").distinct()
    quoted = write_out(passages(quoting), "passages")
    linked = write_out(links(quoted, rows.filter("conv_id is not null").select("conv_id", "turn", "content")), "links")
    counts = quoted.join(linked, ["conv_id", "turn", "text_hash", "number", "level"], "left").groupBy("conv_id", "turn", "text_hash").agg(
        F.count(F.lit(1)).alias("n_quoted"), F.count("writer").alias("n_linked"))
    told = threads(replies(linked))
    out = rows.join(counts, same(rows, counts, ["conv_id", "turn", "text_hash"]), "left").select(rows["*"], "n_quoted", "n_linked")
    out = out.join(told, same(out, told, ["conv_id", "turn"]), "left").select(
        out["*"], told["reply_turn"], F.coalesce(told["root"], out["turn"]).alias("thread_turn"), F.coalesce("depth", F.lit(0)).alias("depth"))
    out = out.fillna({"n_quoted": 0, "n_linked": 0}).withColumn(
        "chat", F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("content"), F.lit("\n")))
    placed = with_running(out, ["conv_id"], ["thread_turn", "depth", "turn", "text_hash"], None, "position")
    return placed.select(*[c if c in used else f"rest.`{c}`" for c in messages.columns if c not in added], *added)


def op10(messages: DataFrame) -> DataFrame:
    return reply_ordered(messages.select("conv_id", "turn", "role", "text")).drop("text")
