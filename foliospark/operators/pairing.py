"""Ordered pairing of calls and results.

A message's calls and results are folded in order. Policies differ in what a
result does whose id matches no open call: nothing, take the first open call of
its kind always, or only if it has no id. A result without a call is a row of its
own, as is a call without a result.
"""

from __future__ import annotations

from collections import OrderedDict, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXACT, FIRST_OF_KIND, FIRST_IF_NO_ID = "exact", "first_of_kind", "first_if_no_id"


class _Message:
    """The open calls of one message, by policy and kind in their order, and by id as well."""

    def __init__(self):
        self.open: dict[tuple, OrderedDict[int, tuple[str, int]]] = defaultdict(OrderedDict)
        self.named: dict[tuple, list[int]] = defaultdict(list)
        self.n = 0

    def latest(self, group: tuple, own: str) -> int | None:
        """The number of the latest open call with that id."""
        stack = self.named.get((group, own), [])
        while stack and stack[-1] not in self.open[group]:
            stack.pop()  # it was taken as the first of its kind
        return stack[-1] if stack else None

    def call(self, group: tuple, own: str, seq: int, replaced: bool) -> list[int]:
        """Opens a call; the places of the calls that it replaces."""
        gone = [self.open[group].pop(n)[1] for n in self.named.pop((group, own), []) if n in self.open[group]] if replaced else []
        self.open[group][self.n] = own, seq
        self.named[group, own].append(self.n)
        self.n += 1
        return gone

    def result(self, group: tuple, own: str) -> tuple[int | None, str | None]:
        """Place of the call that a result ends, and how it was found."""
        policy, calls = group[0], self.open[group]
        n, how = self.latest(group, own) if own or policy != FIRST_OF_KIND else None, "call_id"
        if n is None and calls and (policy == FIRST_OF_KIND or policy == FIRST_IF_NO_ID and not own):
            n, how = next(iter(calls)), "type_fifo_estimate"
        return (calls.pop(n)[1], how) if n is not None else (None, None)


def pair(rows: DataFrame, policy: str | None, replaced: bool = False) -> DataFrame:
    """(message, kind, call, result, association) from rows of message, seq, side (call or result), kind, id.

    association is call_id where the ids agree, type_fifo_estimate where the first
    open call was taken, null where there is no pair. Without a ``policy`` each row
    has its own in a column of that name, and rows meet those of their policy only.
    Messages are dealt to tasks, sorted there and read in one go: a task holds the
    open calls of one message and a batch of rows.
    """
    names = ["message", "kind", "call", "result", "association"]
    columns = ["message", "seq", "side", "kind", "id"] + ([] if policy else ["policy"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, now, kinds = None, _Message(), None

        def left() -> list[tuple]:
            return [(last, group[1], seq, None, None) for group, calls in now.open.items() for _, seq in calls.values()]

        def made(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds, strict=True)], names=names)

        for batch in batches:
            kinds, out = [batch.schema.field("message").type, pa.string(), pa.int64(), pa.int64(), pa.string()], []
            for message, seq, side, kind, own, *its in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if message != last:
                    out += left()
                    last, now = message, _Message()
                group = (its[0] if its else policy, kind)
                if side == "call":
                    out += [(message, kind, gone, None, None) for gone in now.call(group, own or "", seq, replaced)]
                    continue
                call, how = now.result(group, own or "")
                out.append((message, kind, call, seq, how))
            if out:
                yield made(out)
        if out := left():
            yield made(out)

    message = rows.schema["message"].dataType.simpleString()
    dealt = rows.select(*columns).repartition("message").sortWithinPartitions("message", F.asc_nulls_last("seq"))
    return dealt.mapInArrow(fold, f"message {message}, kind string, call long, result long, association string")
