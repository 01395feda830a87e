"""Helpers shared by the operators: input columns, intermediate tables, word hashes."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contact_mart.session import Workspace

# Whitespace of the word rules, as the characters of a regex class: \x20 and \x09 to \x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
SENT_IDS = 2_000_000
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application, so that they need not have it installed."""
    context = spark.sparkContext
    if not getattr(context, "_contact_mart_sent", False):
        package = Path(__file__).resolve().parents[1]
        # On the driver alone, from where Spark serves it; it has to stay as long as the application.
        file = Path(tempfile.mkdtemp(prefix="contact-mart-"), f"{package.name}.zip")
        with zipfile.ZipFile(file, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(str(file))
        context._contact_mart_sent = True


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that bound what one Arrow batch holds and let skewed joins be split."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Tables(Workspace):
    """Intermediate tables by name, in the shared folder; a table can go once its readers have finished."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        self._paths: dict[str, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = self._paths[name] = self.path(name)
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        for name in names:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(name))
            folder.getFileSystem(conf).delete(folder, True)


def texts_of(docs: DataFrame, ids: DataFrame, tables: Tables, name: str) -> DataFrame:
    """doc and text of the documents in ``ids`` (doc), written down so that other texts move once at most.

    Up to SENT_IDS ids, of 8 bytes each, are sent to the tasks that read the documents; more are joined by exchange."""
    ids = tables.put(ids.distinct(), f"ids-{name}")
    side = F.broadcast(ids) if ids.count() <= SENT_IDS else ids
    return tables.put(docs.join(side, "doc", "left_semi").select("doc", "text"), f"texts-{name}")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def without(text: Column, characters: str) -> Column:
    """The text without the given characters."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between whitespace, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


_RNG = np.random.default_rng(20240500)
_OF_BYTE = _RNG.integers(0, 1 << 64, 256, np.uint64)
_BASE = int(_RNG.integers(0, 1 << 62)) * 4 + 3
_STEP = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, np.int8)
_IS_SPACE[list(SPACES.encode())] = 1
# Bytes of a text that are hashed at once; a longer text is cut between words.
_PIECE = 1 << 20
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, kept."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def _hashed(raw: bytes) -> np.ndarray:
    """Hash of each word between whitespace. A word is a polynomial in the base with a random number for each byte; the
    sums over all words come from one running sum."""
    letters = np.frombuffer(raw, np.uint8)
    space = np.ones(len(letters) + 2, np.int8)
    space[1:-1] = _IS_SPACE[letters]
    edge = np.diff(space)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _powers(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(_OF_BYTE[letters] * power[: len(letters)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of every lower-cased (A-Z) word of the whole text, in order."""
    raw = text.encode("utf-8", "surrogatepass").translate(LOWER) if text else b""
    if len(raw) <= _PIECE:
        return _hashed(raw)
    parts, at = [], 0
    while at < len(raw):
        found = re.compile(rb"[\x20\x09-\x0D]").search(raw, min(at + _PIECE, len(raw)))
        end = found.start() if found else len(raw)
        parts.append(_hashed(raw[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_hashes(text: str | None, size: int = 5) -> np.ndarray:
    """Hash of every run of ``size`` words in order; of the whole sequence if it is shorter; empty without words."""
    h = word_hashes(text)
    n = len(h)
    if n == 0:
        return h
    width = min(size, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = out * _STEP + h[k : n - width + 1 + k]
    return mixed(out)
