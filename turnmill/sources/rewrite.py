"""Taking lines out of text files in place, each line by the task that read it.

The kept lines of a file are written in the order they were read, a part per scan split, so nothing is
shuffled. Names of files and folders are text throughout: they are never read as partition values.

A rewrite goes through a folder beside the data, whose name Spark's listings pass over:

1. the new parts are written to `_rewrite/new-...`;
2. a manifest, which says what part takes which name, gets its final name by one rename;
3. every part is renamed to its place; then the folder is deleted.

Until step 2 the old version stands, and after it the new one: whoever reads or rewrites the folder
later, with the functions of `sources.jsonl`, first does what is left of step 3 (`finish`), which may be
repeated at any point. One rewrite at a time may work on a folder.

A file stays a file if one scan split covers it. What is left of a larger one is a folder of
numbered parts under the file's name, which still counts as one corpus.
"""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.session import materialize

FOLDER = "_rewrite"
MANIFEST = "manifest.json"
PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")
# The columns that tell where a line was read.
PLACE = ["_file", "_block", "_seq"]


def hadoop(spark: SparkSession, path: str):
    """The path as its own file system spells it, and that file system."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = named.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(named), system


def is_file(spark: SparkSession, path: str) -> bool:
    named, system = hadoop(spark, path)
    return system.exists(named) and system.getFileStatus(named).isFile()


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """The lines in all files `path` matches, at any depth, without partition columns."""
    return spark.read.option("recursiveFileLookup", True).text(path)


def decoded(name: Column) -> Column:
    """A path of a listing, in which some characters are written as `%XX`, as plain text."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def root_of(spark: SparkSession, path: str) -> str:
    """Start of the listed names of all files `path` matches: its part ahead of any wildcard, or
    the folder of a single file."""
    parts = path.split("/")
    fixed = next((k for k, part in enumerate(parts) if re.search(r"[*?\[{]", part)), len(parts))
    start = "/".join(parts[:fixed]) or "/"
    root, _ = hadoop(spark, start)
    if fixed == len(parts) and is_file(spark, start):
        root = root.getParent()
    return root.toUri().getRawPath().rstrip("/") + "/"


def below(spark: SparkSession, path: str, file: Column) -> Column:
    """The place of a listed file below the fixed part of `path`, as plain text."""
    start = root_of(spark, path)
    return decoded(F.substring(file, F.instr(file, start) + len(start), F.length(file)))


def _control(spark: SparkSession, path: str) -> tuple[str, str]:
    """The folder of a rewrite, and the folder its names are relative to."""
    path = path.rstrip("/")
    if is_file(spark, path):
        parent, _, name = path.rpartition("/")
        return f"{parent}/{FOLDER}-{name}", parent
    return f"{path}/{FOLDER}", path


def finish(spark: SparkSession, path: str) -> None:
    """Complete rewrites that were broken off, of `path`, of folders above it, and up to two levels below."""
    parts = path.rstrip("/").split("/")
    fixed = next((k for k, part in enumerate(parts) if re.search(r"[*?\[{]", part)), len(parts))
    start = "/".join(parts[:fixed])
    above = ["/".join(parts[:k]) for k in range(2, fixed)]
    patterns = [f"{folder}/{FOLDER}/{MANIFEST}" for folder in above]
    patterns += [f"{folder}/{FOLDER}-{parts[fixed - 1]}/{MANIFEST}" for folder in above[-1:]]
    patterns += [f"{start}{depth}/{FOLDER}{kind}/{MANIFEST}" for depth in ("", "/*", "/*/*") for kind in ("", "-*")]
    for pattern in patterns:
        named, system = hadoop(spark, pattern)
        for found in system.globStatus(named) or []:
            _publish(spark, found.getPath().getParent())


def _publish(spark: SparkSession, control) -> None:
    """Give all parts of the manifest in folder `control` their names. Steps done already are passed over."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    _, system = hadoop(spark, control.toString())
    home = control.getParent()
    stream = system.open(at(control, MANIFEST))
    manifest = json.loads(bytes(stream.readAllBytes()).decode())
    stream.close()
    for source, target in manifest["parts"]:
        source, target = at(at(control, manifest["data"]), source), at(home, target)
        if not system.exists(source):
            continue
        folder = target.getParent()
        if system.exists(folder) and system.getFileStatus(folder).isFile():
            system.delete(folder, False)
        system.mkdirs(folder)
        system.delete(target, False)
        if not system.rename(source, target):
            raise OSError(f"{source} could not be renamed to {target}")
    for name in manifest["gone"]:
        system.delete(at(home, name), False)
    system.delete(control, True)


def _commit(spark: SparkSession, control: str, manifest: dict) -> None:
    named, system = hadoop(spark, f"{control}/{MANIFEST}.tmp")
    stream = system.create(named, True)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    if not system.rename(named, hadoop(spark, f"{control}/{MANIFEST}")[0]):
        raise OSError(f"the manifest in {control} could not be renamed")


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files at any depth below `folder`, relative to it."""
    root, system = hadoop(spark, folder)
    if not system.exists(root):
        return []
    start, found = len(root.toString()) + 1, []
    walk = system.listFiles(root, True)
    while walk.hasNext():
        found.append(walk.next().getPath().toString()[start:])
    return found


def _target(name: str, taken: set[str]) -> str:
    """The name of the new version: parts are plain text, so an ending of a packed file goes."""
    for ending in PACKED:
        if name.endswith(ending):
            plain = name[: -len(ending)]
            if plain in taken:
                raise ValueError(f"{name} and {plain} would have one name")
            return plain
    return name


def _plan(staged: list[str], names: dict[str, str]) -> tuple[list[tuple[str, str]], list[str]]:
    """Which staged part takes which name, and which of the `names` (by key) have no part."""
    parts: dict[str, list[tuple[int, str, str]]] = {}
    for path in staged:
        found = re.match(r"kept=true/name=([0-9a-f]+)/block=(\d+)/([^/_.][^/]*)$", path)
        if found:
            parts.setdefault(found[1], []).append((int(found[2]), found[3], path))
    taken, moves = set(names.values()), []
    for key, found in parts.items():
        target = _target(names[key], taken)
        if len(found) == 1:
            moves.append((found[0][2], target))
        else:
            moves += [(path, f"{target}/part-{k:06d}") for k, (*_, path) in enumerate(sorted(found))]
    return moves, [names[key] for key in names if key not in parts]


def staged_lines(spark: SparkSession, path: str, lines: DataFrame, kept: Column) -> DataFrame:
    """What a rewrite writes: `kept, name, block, value`, sorted inside tasks only."""
    own = below(spark, path, F.col("_file"))
    named = lines.select(
        kept.alias("kept"), F.md5(own).alias("name"), F.col("_block").alias("block"), "_seq", "line"
    )
    ordered = named.sortWithinPartitions("kept", "name", "block", "_seq")
    return ordered.select("kept", "name", "block", F.col("line").alias("value"))


def replace_lines(spark: SparkSession, path: str, lines: DataFrame, kept: Column) -> DataFrame:
    """Keep of all files in `path` (a file or a folder) what `kept` is true for: a table `file, n_removed`
    with a row for every file, by its place below `path`.

    `lines` has the rows to decide about, `line` and `PLACE`; what it leaves out goes too, uncounted. One
    pass over the text. A file without kept lines stays as an empty one.
    """
    finish(spark, path)
    control, home = _control(spark, path)
    folder, system = hadoop(spark, control)
    system.delete(folder, True)  # of a rewrite that did not come to its manifest
    listed = text_files(spark, path).inputFiles()
    start = root_of(spark, path)
    own = [unquote(name[name.index(start) + len(start) :]) for name in listed]
    hashed = spark.createDataFrame([(name,) for name in own], "file string").withColumn("name", F.md5("file"))
    names = {row["name"]: row["file"] for row in hashed.collect()}
    data = f"new-{uuid.uuid4().hex}"
    staged_lines(spark, path, lines, kept).write.partitionBy("kept", "name", "block").text(f"{control}/{data}")
    staged = _listed(spark, f"{control}/{data}")
    parts, empty = _plan(staged, names)
    for number, name in enumerate(empty):
        blank = f"empty-{number}"
        system.create(hadoop(spark, f"{control}/{data}/{blank}")[0], True).close()
        parts.append((blank, _target(name, set(names.values()))))
    removed = hashed.withColumn("n_removed", F.lit(0).cast("bigint"))
    if any(part.startswith("kept=false/") for part in staged):
        where = F.regexp_extract(F.col("_metadata.file_path"), "/name=([0-9a-f]+)/", 1)
        taken = text_files(spark, f"{control}/{data}/kept=false").groupBy(where.alias("name"))
        counts = taken.agg(F.count(F.lit(1)).alias("n"))
        removed = hashed.join(counts, "name", "left").withColumn("n_removed", F.coalesce("n", F.lit(0)))
    removed = materialize(removed.select("file", "n_removed"), "removed")
    places = {target for _, target in parts} | {target.rpartition("/")[0] for _, target in parts}
    gone = [name for name in names.values() if name not in places]
    _commit(spark, control, {"data": data, "parts": parts, "gone": gone})
    _publish(spark, folder)
    return removed
