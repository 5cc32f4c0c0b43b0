"""URL filters: all glob rules at once, as a multiword Shift-And automaton.

Every rule is a glob over the canonical url, which is host and path.  A state
of the automaton says how many elements of a glob have been read; the states of
all globs lie side by side in 64-bit words.  One byte of the url moves all of
them with a shift, an AND with the byte's mask and an OR for the wildcards, and
a batch of urls moves in step.

=======  ==========================================
``?``    one byte other than ``/``
``*``    any number of bytes other than ``/``
``**``   any number of bytes
=======  ==========================================

A null url, or one without ``://``, has an empty host and path, fits no rule
and gets the method's verdict for the empty string.  Rows are judged one by
one: repeated rows give repeated results, an empty table an empty one, and
other columns are not looked at.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
#: Cells of urls by states that one step of the automaton holds.
STEP_CELLS = 1_000_000

#: Host and path rules of the query: they fit the host and its subdomains.
SITE_RULES = [
    ("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW),
]
#: Globs that decide where no site rule fits.
GLOB_RULES = [
    ("ads.**", BLOCK), ("*.ads.**", BLOCK), ("**/wp-admin/**", BLOCK), ("**/login", BLOCK),
    ("**/login/**", BLOCK), ("**.exe", BLOCK), ("**.zip", BLOCK),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Automaton:
    """States of all globs: start, per byte the advance and the loop mask, and final bits."""

    start: np.ndarray
    advance: np.ndarray
    loop: np.ndarray
    final_word: np.ndarray
    final_bit: np.ndarray


def compile_globs(globs: list[str]) -> Automaton:
    not_slash = np.ones(256, bool)
    not_slash[ord("/")] = False
    parsed = [re.findall(rb"(?s)\*\*|.", glob.encode()) for glob in globs]
    n_states = sum(1 + sum(part not in (b"*", b"**") for part in parts) for parts in parsed)
    n_words = max(1, -(-n_states // 64))
    start = np.zeros(n_words, np.uint64)
    advance, loop = np.zeros((2, 256, n_words), np.uint64)
    finals, state = [], 0
    for parts in parsed:
        start[state // 64] |= np.uint64(1 << state % 64)
        for part in parts:
            if part in (b"*", b"**"):
                accepted = not_slash if part == b"*" else np.ones(256, bool)
                loop[accepted, state // 64] |= np.uint64(1 << state % 64)
                continue
            state += 1
            accepted = not_slash if part == b"?" else np.arange(256) == part[0]
            advance[accepted, state // 64] |= np.uint64(1 << state % 64)
        finals.append(state)
        state += 1
    finals = np.array(finals, np.int64)
    return Automaton(start, advance, loop, finals // 64, (finals % 64).astype(np.uint64))


def matches(automaton: Automaton, texts: list[bytes]) -> np.ndarray:
    """Which glob matches which whole text: a matrix of texts by globs."""
    out = np.zeros((len(texts), len(automaton.final_word)), bool)
    rows = max(1, STEP_CELLS // len(automaton.start))
    by_length = np.array(sorted(range(len(texts)), key=lambda i: -len(texts[i])), np.int64)
    for low in range(0, len(texts), rows):
        part = by_length[low:low + rows]
        lengths = np.array([len(texts[i]) for i in part])
        data = np.frombuffer(b"".join(texts[i] for i in part), np.uint8)
        begin = np.cumsum(lengths) - lengths
        states = np.tile(automaton.start, (len(part), 1))
        for at in range(lengths.max(initial=0)):
            live = int(np.searchsorted(-lengths, -at, "left"))
            byte, now = data[begin[:live] + at], states[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            states[:live] = moved & automaton.advance[byte] | now & automaton.loop[byte]
        out[part] = states[:, automaton.final_word] >> automaton.final_bit & np.uint64(1)
    return out


def site_globs(rule: str) -> list[str]:
    """Globs of a ``host/path`` rule: the host or a subdomain, and paths that begin so."""
    return [f"{rule}**", f"*.{rule}**"]


def longest_first(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Longest rule first; of equal lengths, the one listed first."""
    return sorted(rules, key=lambda rule: -len(rule[0]))


def first_hit(hits: np.ndarray) -> np.ndarray:
    """Number of the first column set in each row, or -1."""
    if not hits.shape[1]:
        return np.full(len(hits), -1)
    return np.where(hits.any(axis=1), hits.argmax(axis=1), -1)


def canonical(pages: DataFrame) -> DataFrame:
    """Page id, host with A-Z lower-cased, and path, both empty without ``://``."""
    return pages.select(
        "page_id",
        F.coalesce(F.translate(F.regexp_extract("url", "://([^/?#]*)", 1), UPPER, LOWER),
                   F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"),
    )


def filter_urls(
    pages: DataFrame,
    site_rules: list[tuple[str, str]] = SITE_RULES,
    glob_rules: list[tuple[str, str]] = GLOB_RULES,
    default: str = ALLOW,
) -> DataFrame:
    """Verdict of every page's url: the longest site rule, else the longest glob, else ``default``."""
    sites, globs = longest_first(site_rules), longest_first(glob_rules)
    automaton = compile_globs(
        [glob for rule, _ in sites for glob in site_globs(rule)] + [glob for glob, _ in globs]
    )
    names = np.array([rule for rule, _ in sites] + [None], object)
    site_verdicts = np.array([verdict for _, verdict in sites] + [None], object)
    glob_verdicts = np.array([verdict for _, verdict in globs] + [default], object)

    def judge(batches):
        for batch in batches:
            texts = [(host + path).encode() for host, path in
                     zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)]
            hits = matches(automaton, texts)
            of_site = hits[:, :2 * len(sites)]
            site = first_hit(of_site[:, ::2] | of_site[:, 1::2])
            verdict = np.where(site >= 0, site_verdicts[site],
                               glob_verdicts[first_hit(hits[:, 2 * len(sites):])])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[site], pa.string()),
                 pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    found = canonical(pages)
    page_id = found.schema["page_id"].dataType.simpleString()
    return found.mapInArrow(
        judge, f"page_id {page_id}, host string, path string, rule string, verdict string"
    )


def op10_url_filters(spark, sf_dir) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLE = f"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%'
      THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%'
      THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_full_match(host || path,
    '(?s)(ads\\..*|[^/]*\\.ads\\..*|.*/wp-admin/.*|.*/login|.*/login/.*|.*\\.exe|.*\\.zip)')
    THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled
"""
