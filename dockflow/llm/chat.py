"""Operator 2: chat formatting with prefix-target expansion.

A conversation's turns become segments of one transcript with character offsets.  Every assistant turn is exploded into an
example of its own: its context is the transcript before it, its target the reply, and only the reply is under the loss
mask.  An example row holds (context end, loss start, loss end) on the shared transcript, so what is written stays linear in the text
however many turns a conversation has; ``example_texts`` writes examples out in full where that is wanted.  Digests are
read back from the two written tables: turns from the segments, and all that concerns the loss from the example rows. Every example's whole
text, context and reply, is digested: the digest of a conversation's transcript so far is copied where an example's context ends, so that
this is linear too.

Template: ``<|role|>\\n`` text ``<|end|>\\n``.  Inside texts and roles ``\\``, ``<`` and ``[`` become ``\\s``, ``\\l``
and ``\\b``: no control string of this or of the common bracket templates survives, and reading reverses it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store

END = "<|end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescape(text: str) -> str:
    return text.replace("\\l", "<").replace("\\b", "[").replace("\\s", "\\")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The table and one more conversation, -1, whose turns say what a control string says."""
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The transcript: one row per turn with its segment, where it lies, and where its text does, in characters.

    Turns stand in order of turn, then role, then text; null texts and roles are empty; a null conv_id is a conversation
    of its own; repeated rows are turns; other columns are ignored; an empty table gives no rows. Offsets are a running sum over a
    conversation, which Spark sorts and spills, whatever its length."""
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ready = conversations.select("conv_id", "turn", role, text).withColumns({"head": F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>\n")), "body": escape(F.col("text"))})
    turns = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    sized = ready.withColumn("size", (F.length("head") + F.length("body") + len(END)).cast("long"))
    placed = sized.withColumns({"seq": F.row_number().over(turns) - 1, "seg_end": F.sum("size").over(turns.rowsBetween(Window.unboundedPreceding, 0))})
    start = F.col("seg_end") - F.col("size")
    return placed.select(
        "conv_id", F.col("seq").cast("long").alias("seq"), (F.col("role") == "assistant").alias("replies"), F.concat("head", "body", F.lit(END)).alias("segment"),
        start.alias("seg_start"), "seg_end", (start + F.length("head")).alias("text_start"), (F.col("seg_end") - len(END)).alias("text_end"))


def examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, target (its seq), context_end, loss_start, loss_end, example_end."""
    return formatted.where("replies").select("conv_id", F.col("seq").alias("target"), F.col("seg_start").alias("context_end"), F.col("text_start").alias("loss_start"), F.col("text_end").alias("loss_end"), F.col("seg_end").alias("example_end"))


def example_texts(formatted: DataFrame) -> DataFrame:
    """Every example written out: conv_id, target, text, loss_start, loss_end. Output grows with the square of the turns."""
    e, f = examples(formatted), formatted.select("conv_id", "seq", "segment")
    whole = e.join(f, e.conv_id.eqNullSafe(f.conv_id) & (f.seq <= e.target)).groupBy(e.conv_id, "target", "loss_start", "loss_end").agg(F.array_sort(F.collect_list(F.struct("seq", "segment"))).alias("parts"))
    return whole.select("conv_id", "target", F.concat_ws("", F.col("parts.segment")).alias("text"), "loss_start", "loss_end")


def read_back(transcript: DataFrame, expanded: DataFrame) -> DataFrame:
    """Digests read from the written segments and examples alone, one row per conversation. A task streams its conversations in
    order and holds one segment, whatever the length of a conversation (a digest of joined texts would hold all of it). ``examples_sha256`` is the digest of the
    hex digests of its examples' texts, in order. An example whose context isn't the transcript before its reply is a ValueError."""
    segments = transcript.select("conv_id", "seq", F.lit(1).alias("kind"), "segment", F.col("seg_start").alias("a"), F.col("seg_end").alias("b"))
    targets = expanded.select("conv_id", F.col("target").alias("seq"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("segment"), F.col("loss_start").alias("a"), F.col("loss_end").alias("b"), F.col("context_end").alias("c"), F.col("example_end").alias("d"))
    segments = segments.withColumns({"c": F.lit(None).cast("long"), "d": F.lit(None).cast("long")})
    ordered = segments.unionByName(targets).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "kind").drop("seq")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long, example_chars long, examples_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        arrow = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])
        last, state, target = None, None, None

        def row(s):
            return [s["conv"], s["turns"], s["all"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["end"], s["examples"], s["example_chars"], s["each"].hexdigest()]

        for batch in batches:
            done = []
            for conv, kind, segment, a, b, c, d in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if state is None or conv != last:
                    if state is not None:
                        done.append(row(state))
                    last, state = conv, {"conv": conv, "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "end": 0, "examples": 0, "example_chars": 0, "context": hashlib.sha256(), "each": hashlib.sha256()}
                if kind == 0:
                    target = (a, b, c, d)  # the example whose reply is the next segment
                    continue
                head, _, rest = segment.partition("|>\n")
                role, text = unescape(head[2:]), unescape(rest[: len(rest) - len(END)])
                state["turns"] += 1
                state["all"].update(f"{role}\n{text}\n".encode())
                state["end"] = b
                if target is not None:
                    start, stop, context_end, example_end = target
                    if context_end != a:
                        raise ValueError(f"conversation {conv}: an example's context ends at {context_end}, its reply's segment starts at {a}")
                    whole = state["context"].copy()
                    whole.update(segment[: example_end - a].encode())
                    state["each"].update(whole.hexdigest().encode())
                    reply = unescape(segment[start - a : stop - a])
                    state["chars"] += len(reply)
                    state["loss"].update(reply.encode())
                    state["examples"] += 1
                    state["example_chars"] += example_end
                    target = None
                state["context"].update(segment.encode())
            if done:
                yield pa.RecordBatch.from_pydict({n: [d[i] for d in done] for i, n in enumerate(names)}, schema=arrow)
        if state is not None:
            yield pa.RecordBatch.from_pydict({n: [x] for n, x in zip(names, row(state), strict=True)}, schema=arrow)

    return ordered.mapInArrow(run, schema)


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """Write the transcript and its examples, and read their digests back. Nulls, ties, repeats and empty tables: see ``format_conversations``."""
    formatted = store.written(format_conversations(conversations), "chat")
    return read_back(formatted, store.written(examples(formatted), "chat-examples"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe. Null texts and roles are empty; ties of turn stand by role, then text; repeated rows are turns; a null
    conv_id is a conversation; rows of conversation -1, if the table has any, are one conversation with the probe's; other columns are ignored; an empty
    table gives the probe alone."""
    return formatted_digests(with_probe(store.table(spark, sf_dir, "conversations")))


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), l AS (
  SELECT *, 2 + length(replace(replace(replace(role, '\\', '\\s'), '<', '\\l'), '[', '\\b')) + 3
    + length(replace(replace(replace(text, '\\', '\\s'), '<', '\\l'), '[', '\\b')) + 8 AS chars,
    '<|' || replace(replace(replace(role, '\\', '\\s'), '<', '\\l'), '[', '\\b') || '|>' || chr(10) || replace(replace(replace(text, '\\', '\\s'), '<', '\\l'), '[', '\\b') || '<|end|>' || chr(10) AS segment FROM t
), r AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
    sha256(string_agg(segment, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)) AS example FROM l
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  count(*) FILTER (WHERE role = 'assistant') AS n_examples,
  coalesce(sum(upto) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS example_chars,
  sha256(coalesce(string_agg(example, '' ORDER BY upto) FILTER (WHERE role = 'assistant'), '')) AS examples_sha256
FROM r GROUP BY conv_id
"""
