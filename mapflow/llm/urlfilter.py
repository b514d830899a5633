"""URL filters on a sorted digest array.

Rules and blocklist entries are host-and-path prefixes.  Each is stored once under
the 64-bit xxhash of its string: keys sorted, strings beside them, in files that
every worker maps into memory, so a list costs disk and page cache, not heap.  A
url is cut into candidates (its host and parent domains, with the path prefixes of
the lengths that occur in the list), whose digests are looked up by vectorised
binary search; a hit counts only if the stored string is the candidate itself.  Host ends longer than the longest listed
host cannot be listed and are not made, so a url's candidates are bounded by the list, not by the url.

Files hold ``shard_entries`` entries at most each; a longer list becomes more files,
split by digest, and a worker touches only the pages its digests fall on.  The files
go to the executors through Spark's file distribution.

Null urls and urls without ``://``: empty host and path, no rule, allowed.  Null
``page_id``: kept.  Repeated rows are judged each.  Empty table: no rows.  Ties: the longest
rule that fits decides, of equally long ones that of the longer host.  Further columns are not read and never clash.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table

# The rules (verdict, host, path) of the registered query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: The registered query's blocklist: hosts known for spam, with all their subdomains.
BLOCKLIST = tuple(f"{name}.example.{top}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
                  for top in ("com", "net", "org"))
VERDICTS = "page_id long, host string, path string, rule string, verdict string, listed string"


def write_digest_array(entries: Iterable[tuple[str, int]], folder: str, shard_entries: int = 4_000_000,
                       digest=xxhash.xxh64_intdigest) -> list[str]:
    """Files of the sorted digest array of ``entries`` (string, tag); returns their paths.

    A file: count; keys (sorted); tags; string ends; strings, end to end.
    """
    rows = sorted({(digest(s.encode()), s, tag) for s, tag in entries})
    paths = []
    for k in range(0, max(1, len(rows)), shard_entries):
        part = rows[k:k + shard_entries]
        blobs = [s.encode() for _, s, _ in part]
        path = f"{folder}/digests-{uuid.uuid4().hex[:12]}-{k // shard_entries:05d}.bin"
        with open(path, "wb") as f:
            f.write(np.array([len(part)], "<u8").tobytes())
            f.write(np.array([r[0] for r in part], "<u8").tobytes())
            f.write(np.array([r[2] for r in part], "<i8").tobytes())
            f.write(np.cumsum([0, *map(len, blobs)]).astype("<i8").tobytes())
            f.write(b"".join(blobs))
        paths.append(path)
    return paths


class DigestArray:
    """The files of ``write_digest_array``, mapped; ``find`` gives the tags of strings (-1: not there)."""

    def __init__(self, paths: list[str], digest=xxhash.xxh64_intdigest):
        self.digest, self.shards = digest, []
        for path in paths:
            n = int(np.fromfile(path, "<u8", 1)[0])
            if n:
                raw = np.memmap(path, np.uint8, "r")
                keys, tags = raw[8:8 + 8 * n].view("<u8"), raw[8 + 8 * n:8 + 16 * n].view("<i8")
                ends = raw[8 + 16 * n:16 + 24 * n].view("<i8")
                self.shards.append((keys, tags, ends, raw[16 + 24 * n:]))

    def find(self, strings: list[str]) -> np.ndarray:
        blobs = [s.encode("utf-8", "surrogatepass") for s in strings]
        digests = np.array([self.digest(b) for b in blobs], np.uint64)
        out = np.full(len(strings), -1, np.int64)
        order = np.argsort(digests, kind="stable")
        ranked = digests[order]
        for keys, tags, ends, text in self.shards:
            # Only the digests within a shard's range are looked up in it.
            mine = order[np.searchsorted(ranked, keys[0], "left"):np.searchsorted(ranked, keys[-1], "right")]
            first, after = np.searchsorted(keys, digests[mine], "left"), np.searchsorted(keys, digests[mine], "right")
            for k in np.flatnonzero(after > first):
                i = mine[k]
                for j in range(first[k], after[k]):  # more than one: different strings with one digest
                    if text[ends[j]:ends[j + 1]].tobytes() == blobs[i]:
                        out[i] = tags[j]
        return out


def candidates(host: str, path: str, lengths: list[int], longest: int) -> list[str]:
    """The host and its parent domains of at most ``longest`` characters, each with the path prefixes of ``lengths``."""
    ends, dot = [], len(host)
    while dot >= 0:
        dot = host.rfind(".", 0, dot)
        if len(host) - dot - 1 > longest:
            break
        ends.append(host[dot + 1:])
    return [h + path[:n] for h in ends for n in lengths if n <= len(path)]


_OPEN: dict[tuple[str, ...], DigestArray] = {}


def filter_urls(pages: DataFrame, rules=RULES, blocklist: Iterable[str] = BLOCKLIST, shard_entries: int = 4_000_000) -> DataFrame:
    """One row per page: host, path, the longest fitting rule, the verdict, and the blocklist entry that was hit.

    A rule decides; without one, a url whose host, parent domain or a prefix of
    both with the path is listed is blocked, any other allowed.
    """
    spark, rules, listed = pages.sparkSession, tuple(rules), sorted(set(blocklist))
    names = [host + path for _, host, path in rules]
    lengths = sorted({len(p) for _, _, p in rules} | {len(e.partition("/")[1] + e.partition("/")[2]) for e in listed})
    longest = max([len(h) for _, h, _ in rules] + [len(e.partition("/")[0]) for e in listed], default=0)
    entries = [(n, i) for i, n in enumerate(names)] + [("\n" + e, len(rules) + i) for i, e in enumerate(listed)]
    folder = tempfile.mkdtemp(prefix="mapflow-digests-")
    files = []
    for p in write_digest_array(entries, folder, shard_entries):
        spark.sparkContext.addFile(p)
        files.append(Path(p).name)
    verdicts = [v for v, _, _ in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = tuple(files)
        if key not in _OPEN:
            _OPEN[key] = DigestArray([SparkFiles.get(f) for f in files])
        array = _OPEN[key]
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            strings, owner = [], []
            for i, (h, p) in enumerate(zip(hosts, paths)):
                own = candidates(h, p, lengths, longest) if h else []
                strings += own
                strings += ["\n" + c for c in own]
                owner += [i] * (2 * len(own))
            distinct = list(dict.fromkeys(strings))
            tags = dict(zip(distinct, array.find(distinct).tolist()))
            rule, entry = [None] * len(hosts), [None] * len(hosts)
            for i, s in zip(owner, strings):
                t = tags[s]
                if t >= len(rules):
                    entry[i] = s[1:] if entry[i] is None or len(s) > len(entry[i]) else entry[i]
                elif t >= 0 and (rule[i] is None or len(names[t]) > len(names[rule[i]])):
                    rule[i] = t
            verdict = [verdicts[r] if r is not None else "block" if e is not None else "allow" for r, e in zip(rule, entry)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([None if r is None else names[r] for r in rule], pa.string()),
                 pa.array(verdict, pa.string()), pa.array(entry, pa.string())],
                ["page_id", "host", "path", "rule", "verdict", "listed"])

    url = pages["url"].cast("string")
    after = F.expr("substring(u, instr(u, '://') + 3)")
    cut = (pages.select(pages["page_id"].cast("long").alias("page_id"), url.alias("u"))
           .select("page_id", F.when(F.expr("instr(u, '://') > 0"), after).otherwise(F.lit("")).alias("rest"))
           .select("page_id",
                   F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
                   F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path")))
    return map_arrow(cut, run, VERDICTS)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = """
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
rules(verdict, h, p) as (values %s),
listed(entry) as (values %s),
ruled as (
  select page_id, max_by(h || p, length(h || p)) as rule, max_by(verdict, length(h || p)) as verdict
  from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id),
hit as (
  select distinct page_id from parts join listed on host = entry or ends_with(host, '.' || entry))
select parts.page_id, host, path, ruled.rule,
       coalesce(ruled.verdict, case when hit.page_id is not null then 'block' else 'allow' end) as verdict
from parts left join ruled using (page_id) left join hit using (page_id)
""" % (", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES), ", ".join(f"('{e}')" for e in BLOCKLIST))
