"""Delivery of message parts to a record store that may lose answers, refuse, close or be ahead.

Parts are delivered in numbered batches. A batch that was sent stays pending,
word for word, until it is acknowledged: it is sent again as it was, even if the
parts have changed since, as the store may hold it already under its number. An
acknowledged part is clean only if it still equals what was sent; a newer one
goes out with the next batch. So a lost acknowledgement costs a repetition and
never a newer content.

All messages go side by side, as tables:

* local: message, key, sequence and the columns of a part, at most one row a key
* pending: message, number, key, sequence and the part's columns as they were sent
* sent: message, number, for the last acknowledged number
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

BATCH_PARTS, BATCH_BYTES = 4, 250 << 10
#: States in which a job takes parts.
ACTIVE = ("dispatching", "pending", "running")
KEY = ["message", "key"]


def content_columns(parts: DataFrame) -> list[str]:
    return [c for c in parts.columns if c not in (*KEY, "number")]


def size_of(parts: DataFrame) -> Column:
    """Bytes of a part as JSON, and the comma behind it."""
    return F.octet_length(F.to_json(F.struct("key", *content_columns(parts)), {"ignoreNullFields": "false"})) + 2


def dirty(local: DataFrame, saved: DataFrame) -> DataFrame:
    """Parts of ``local`` that ``saved`` lacks or has otherwise."""
    columns = content_columns(local)
    other = saved.select(*KEY, F.struct(*columns).alias("__saved"))
    return local.join(other, KEY, "left").filter(~F.struct(*columns).eqNullSafe(F.col("__saved"))).drop("__saved")


def first_batches(parts: DataFrame, most_parts: int = BATCH_PARTS, most_bytes: int = BATCH_BYTES) -> DataFrame:
    """The parts of each message's next batch: in order, so many, as long as they fit; a part that is too large alone goes alone.

    A message has 10,000 parts at most, so its window is bounded.
    """
    order = Window.partitionBy("message").orderBy("sequence", "key")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = parts.withColumn("__place", F.row_number().over(order)).withColumn("__bytes", F.sum(size_of(parts)).over(before))
    return placed.filter((F.col("__place") <= most_parts) & ((F.col("__place") == 1) | (F.col("__bytes") <= most_bytes))).drop("__place", "__bytes")


def outgoing(local: DataFrame, saved: DataFrame, pending: DataFrame, sent: DataFrame) -> DataFrame:
    """(message, number, key, ..., again): what is to be sent now; a message with a pending batch sends that, as it was."""
    waiting = pending.select("message").distinct()
    new = first_batches(dirty(local, saved).join(waiting, "message", "left_anti"))
    numbered = new.join(sent.select("message", F.col("number").alias("__last")), "message", "left").withColumn("number", (F.coalesce("__last", F.lit(0)) + 1).cast("long")).drop("__last")
    return pending.withColumn("again", F.lit(True)).unionByName(numbered.withColumn("again", F.lit(False)))


def acknowledged(saved: DataFrame, batch: DataFrame, acks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(saved, pending) after answers (message, state): what was accepted is saved as it was sent; batches without an answer stay pending."""
    own = batch.drop("again")
    answered = own.join(acks.filter("state = 'accepted'").select("message"), "message", "left_semi").drop("number")
    columns = saved.columns
    rest = saved.join(answered.select(*KEY), KEY, "left_anti")
    waiting = own.join(acks.select("message"), "message", "left_anti")
    return rest.select(columns).unionByName(answered.select(columns)), waiting


def admitted(batch: DataFrame, jobs: DataFrame, messages: DataFrame) -> DataFrame:
    """``batch`` with state: closed where its job or message takes no more, else send, and the number that the store expects.

    jobs: message, status, execution, wanted (the execution that delivers), cancelled;
    messages: message, status, number (of the last batch that the store took).
    """
    open_job = F.col("__job").isin(*ACTIVE) & ~F.coalesce(F.col("__cancelled"), F.lit(False)) & F.col("__execution").eqNullSafe(F.col("__wanted"))
    j = jobs.select("message", F.col("status").alias("__job"), F.col("execution").alias("__execution"), F.col("wanted").alias("__wanted"), F.col("cancelled").alias("__cancelled"))
    m = messages.select("message", F.col("status").alias("__status"), F.col("number").alias("__number"))
    checked = batch.drop("number").join(j, "message", "left").join(m, "message", "left")
    state = F.when(F.coalesce(open_job & (F.col("__status") == "running"), F.lit(False)), "send").otherwise("closed")
    own = ["__job", "__execution", "__wanted", "__cancelled", "__status", "__number"]
    return checked.withColumn("state", state).withColumn("number", (F.coalesce("__number", F.lit(0)) + 1).cast("long")).drop(*own)


def verified(batch: DataFrame, saved: DataFrame) -> DataFrame:
    """(message, whole): whether the store holds every part of a batch as it was sent, whatever its answer said."""
    columns = content_columns(saved)
    held = saved.select(*KEY, F.struct(*columns).alias("__saved"))
    equal = F.struct(*columns).eqNullSafe(F.col("__saved"))
    return batch.join(held, KEY, "left").groupBy("message").agg(F.bool_and(equal).alias("whole"))


class Repair:
    """Brings a store's parts in line with the local ones, without a claim to the messages.

    store.state() gives the tables (jobs, messages, saved) as they are now;
    store.post(batch) delivers (message, number, key, ...) and returns (message,
    answer): accepted, conflict (the number isn't the expected one), duplicate
    (taken for one that was there), closed, or no row where the answer was lost.
    """

    def __init__(self, store, attempts: int = 12):
        self.store, self.attempts = store, attempts

    def run(self, local: DataFrame) -> DataFrame:
        """(message, state, batches, attempts) with state delivered, closed or failed: no verified answer in so many attempts for a batch.

        A round is one pass over the messages that are left; each sends one batch.
        """
        local = stored(local)
        progress = local.select("message").distinct().select("message", F.lit("open").alias("state"), F.lit(0).cast("long").alias("batches"), F.lit(0).alias("tries"), F.lit(0).cast("long").alias("attempts"))
        progress = stored(progress)
        while True:
            jobs, messages, saved = self.store.state()
            alive = progress.filter("state = 'open'").select("message")
            batch = stored(first_batches(dirty(local.join(alive, "message", "left_semi"), saved)))
            asked = stored(admitted(batch, jobs, messages))
            answers = stored(self.store.post(asked.filter("state = 'send'").drop("state")))
            _, _, saved = self.store.state()
            whole = verified(asked.filter("state = 'send'"), saved)
            closed = asked.filter("state = 'closed'").select("message").unionByName(answers.filter("answer = 'closed'").select("message")).distinct().withColumn("__closed", F.lit(True))
            tried = asked.filter("state = 'send'").select("message").distinct().withColumn("__tried", F.lit(True))
            now = progress.join(closed, "message", "left").join(tried, "message", "left").join(whole, "message", "left")
            shut, sent, kept = (F.coalesce(F.col(c), F.lit(False)) for c in ("__closed", "__tried", "whole"))
            tries = F.when(kept, 0).otherwise(F.col("tries") + sent.cast("int"))
            state = F.when(F.col("state") != "open", F.col("state")).when(shut, "closed").when(~sent, "delivered").when(tries >= self.attempts, "failed").otherwise("open")
            progress = stored(now.select("message", state.alias("state"), (F.col("batches") + (kept & ~shut).cast("long")).alias("batches"), tries.alias("tries"), (F.col("attempts") + sent.cast("long")).alias("attempts")))
            if not progress.filter("state = 'open'").limit(1).count():
                return progress.select("message", "state", "batches", "attempts")


def deliver_stream(stream: DataFrame, local: Callable[[], DataFrame], upsert: Callable[[DataFrame], None], store, checkpoint: str, attempts: int = 12):
    """Start delivery of a stream of parts: each micro-batch is merged into the local parts, then what is dirty goes out.

    A micro-batch that comes again, after a crash, merges to the same rows and finds them clean.
    """

    def each(batch: DataFrame, _: int) -> None:
        upsert(batch)
        touched = batch.select("message").distinct()
        Repair(store, attempts).run(local().join(touched, "message", "left_semi"))

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
