"""Fragments of one message put into slots: the rule that batches and streams share.

One message at a time is open in a group (a source's lines of one sentence type, count, sequence id and channel). The
first fragment that finds none open opens one and gives it its time, tags and line. A fragment takes the slot of its
number, whatever the order; one whose slot is taken, or whose number is out of range, changes nothing. When all slots
are taken the message is done and the next fragment opens another. A fragment that comes more than ``timeout_ms`` after
the message's time gives it up first, and opens another. What is given up, or can't be joined, comes out fragment by
fragment, in the order of their numbers, with the message's time but its own line, and without tags; a partial message is joined from the slots that it has.
"""

from __future__ import annotations

from dataclasses import dataclass, field

TIMEOUT_MS = 600_000
#: What comes out: line and ts_ms, body (a joined sentence's, or null), tags and raw (a fragment's own sentence, or null).
OUT = ("line", "ts_ms", "body", "tags", "raw")


@dataclass
class Open:
    """An open message; parts are by number: (armor, fill, sentence, line)."""

    line: int
    ts_ms: int
    tags: str
    start: str
    channel: str
    count: int
    parts: dict[int, tuple] = field(default_factory=dict)

    def joined(self) -> list[tuple]:
        """The sentence of the slots that are taken, in order; or its fragments, if one of them lacks a field."""
        numbers = sorted(self.parts)
        if not numbers or any(self.parts[n][0] is None or self.parts[n][1] is None for n in numbers):
            return self.given_up()
        armor = "".join(self.parts[n][0] for n in numbers)
        body = f"{self.start.lstrip('!$')},1,1,,{self.channel},{armor},{self.parts[numbers[-1]][1]}"
        return [(self.line, self.ts_ms, body, self.tags, None)]

    def given_up(self) -> list[tuple]:
        return [(self.parts[n][3], self.ts_ms, None, "", self.parts[n][2]) for n in sorted(self.parts)]


def take(held: Open | None, row: dict, timeout_ms: int = TIMEOUT_MS) -> tuple[Open | None, list[tuple]]:
    """The message that is open after a fragment (line, ts_ms, tags, start, channel, count, number, armor, fill, text), and what came out."""
    out = []
    if held is not None and row["ts_ms"] - held.ts_ms > timeout_ms:
        out, held = held.given_up(), None
    if held is None:
        held = Open(row["line"], row["ts_ms"], row["tags"], row["start"], row["channel"] or "", row["count"])
    if 1 <= row["number"] <= held.count:
        held.parts.setdefault(int(row["number"]), (row["armor"], row["fill"], row["text"], row["line"]))
    if len(held.parts) == held.count:
        return None, out + held.joined()
    return held, out
