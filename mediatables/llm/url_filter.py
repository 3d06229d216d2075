"""URL rules by a bit-parallel wildcard automaton.

All globs become one Shift-And automaton whose states are bits packed over
several 64-bit words; every pattern is simulated at once, and numpy steps a
whole Arrow batch of canonical URLs by one byte at a time. URLs are stepped
in order of length, so a long one costs its own bytes only.

Globs match a whole canonical URL (host, A-Z lower-cased, followed by the
path): ``**`` any bytes, ``*`` any bytes but ``/``, ``?`` one byte but ``/``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_list, small_batches

# Domain rules (rule, verdict): a host and its subdomains, then a path prefix.
DOMAIN_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
# Globs that block a URL which no domain rule decides.
BLOCK_GLOBS = (
    "**casino**", "**free-bets**", "**cheap-pills**", "**adult-x**", "**/wp-login*", "**/cgi-bin/**",
)

ONE = np.uint64(1)
TOP = np.uint64(63)


@dataclass(frozen=True)
class Automaton:
    """step: by byte and word, states that the byte may enter; hold: states
    that the byte leaves standing; start: states before the first byte;
    final: the accepting state of each pattern, as (word, bit)."""

    step: np.ndarray
    hold: np.ndarray
    start: np.ndarray
    final: list[tuple[int, np.uint64]]


def _states(glob: str) -> list[tuple[int, set[int] | None]]:
    """Per state after the start: which bytes enter it. Loops come apart."""
    out: list[tuple[int, set[int] | None]] = []
    data = glob.encode()
    at = 0
    loop = 0
    while at < len(data):
        if data[at:at + 2] == b"**":
            loop, at = 2, at + 2
        elif data[at:at + 1] == b"*":
            loop, at = max(loop, 1), at + 1
        else:
            out.append((loop, None if data[at:at + 1] == b"?" else {data[at]}))
            loop, at = 0, at + 1
    out.append((loop, set()))
    return out


def compile_globs(globs: Iterable[str]) -> Automaton:
    """Pack the states of all globs one after another.

    State 0 of a glob is its start and no byte enters it, so a bit shifted
    over from the glob before is dropped.
    """
    enter: list[set[int] | None] = []
    loops: list[int] = []
    starts: list[int] = []
    finals: list[int] = []
    for glob in globs:
        starts.append(len(enter))
        enter.append(set())
        for loop, taken in _states(glob):
            loops.append(loop)  # the loop of the state before this byte
            if taken != set():
                enter.append(taken)
        finals.append(len(enter) - 1)
    words = max(1, -(-len(enter) // 64))
    step = np.zeros((256, words), np.uint64)
    hold = np.zeros((256, words), np.uint64)
    start = np.zeros(words, np.uint64)
    slash = ord("/")
    for state, (taken, loop) in enumerate(zip(enter, loops)):
        word, bit = state // 64, ONE << np.uint64(state % 64)
        if taken is None:
            step[:, word] |= bit
            step[slash, word] &= ~bit
        for byte in taken or ():
            step[byte, word] |= bit
        if loop:
            hold[:, word] |= bit
            if loop == 1:
                hold[slash, word] &= ~bit
    for state in starts:
        start[state // 64] |= ONE << np.uint64(state % 64)
    return Automaton(step, hold, start, [(s // 64, ONE << np.uint64(s % 64)) for s in finals])


def match(automaton: Automaton, urls: list[bytes]) -> np.ndarray:
    """A boolean per URL and glob."""
    lengths = np.fromiter(map(len, urls), np.int64, len(urls))
    order = np.argsort(-lengths, kind="stable")
    ordered = lengths[order]
    data = np.frombuffer(b"".join(urls) + b"\0", np.uint8)
    begins = (np.cumsum(lengths) - lengths)[order]
    state = np.broadcast_to(automaton.start, (len(urls), len(automaton.start))).copy()
    for at in range(int(ordered[0]) if len(urls) else 0):
        live = int(np.searchsorted(-ordered, -at, side="left"))  # URLs longer than at
        byte = data[begins[:live] + at]
        now = state[:live]
        moved = now << ONE
        moved[:, 1:] |= now[:, :-1] >> TOP
        state[:live] = (moved & automaton.step[byte]) | (now & automaton.hold[byte])
    out = np.empty((len(urls), len(automaton.final)), bool)
    for g, (word, bit) in enumerate(automaton.final):
        out[order, g] = (state[:, word] & bit) != 0
    return out


SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("host", T.StringType()),
    T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()),
    T.StructField("verdict", T.StringType()),
])


def rule_globs(rule: str) -> tuple[str, str]:
    """A domain rule as globs: the host itself, and any subdomain of it."""
    return f"{rule}**", f"*.{rule}**"


def _judge(rules: tuple[tuple[str, str], ...], globs: tuple[str, ...], default: str):
    by_length = sorted(rules, key=lambda r: -len(r[0]))
    patterns = [g for rule, _ in by_length for g in rule_globs(rule)] + list(globs)
    automaton = compile_globs(patterns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = bytes_list(batch.column(1)), bytes_list(batch.column(2))
            hits = match(automaton, [h + p for h, p in zip(hosts, paths)])
            ruled = hits[:, :2 * len(by_length)].reshape(len(hosts), -1, 2).any(axis=2)
            blocked = hits[:, 2 * len(by_length):].any(axis=1)
            first = np.where(ruled.any(axis=1), ruled.argmax(axis=1), -1) if by_length else np.full(len(hosts), -1)
            names = [by_length[i][0] if i >= 0 else None for i in first]
            verdicts = [by_length[i][1] if i >= 0 else "block" if b else default for i, b in zip(first, blocked)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array(names, pa.string()), pa.array(verdicts, pa.string())], names=SCHEMA.names)

    return run


def url_verdicts(pages: DataFrame, rules: tuple[tuple[str, str], ...] = DOMAIN_RULES,
                 globs: tuple[str, ...] = BLOCK_GLOBS, default: str = "allow",
                 url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Host, path, the longest domain rule that fits and the verdict per page.

    A null URL, or one without ``://``, has empty host and path and gets the
    default. Null and repeated ids pass through; extra columns are ignored;
    an empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    narrow = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, lower).alias("host"),
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"))
    return narrow.mapInArrow(_judge(tuple(rules), tuple(globs), default), SCHEMA)
