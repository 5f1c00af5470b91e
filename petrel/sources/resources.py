"""Association resources: exact headers, gzip checks, scans, and a store that fetches what is missing.

Each resource is one delimited text file (gzip or plain). A gzip file is read by one task; convert
it once with ``to_parquet`` and later scans are split, pruned and filtered at the source.
"""

from __future__ import annotations

import gzip
import os
import shutil
import tempfile
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The resources' roles, names, headers and types.
FILES = {"protein_info": "protein.info", "protein_aliases": "protein.aliases", "protein_links": "protein.links", "enrichment_terms": "protein.enrichment.terms"}
HEADERS = {
    "protein_info": "#string_protein_id\tpreferred_name\tprotein_size\tannotation",
    "protein_aliases": "#string_protein_id\talias\tsource",
    "protein_links": "protein1 protein2 combined_score",
    "enrichment_terms": "#string_protein_id\tcategory\tterm\tdescription",
}
SCHEMAS = {
    "protein_info": "protein_id string, name string, protein_size int, annotation string",
    "protein_aliases": "protein_id string, alias string, source string",
    "protein_links": "src string, dst string, score int",
    "enrichment_terms": "id string, category string, term string, description string",
}
SPECIES, VERSION = 9606, "12.0"
#: Where the resources' provider offers them.
DOWNLOADS = "https://stringdb-downloads.org/download"


class ResourceError(ValueError):
    """A resource is missing or not what it should be."""


def filename(role: str, species: int = SPECIES, version: str = VERSION) -> str:
    if (species, version) != (SPECIES, VERSION):
        raise ResourceError(f"only species {SPECIES} of version {VERSION} is supported")
    return f"{species}.{FILES[role]}.v{version}.txt.gz"


def first_line(path: str) -> str:
    """The first line of a gzip or plain file."""
    with open(path, "rb") as f:
        packed = f.read(2) == b"\x1f\x8b"
    if path.endswith(".gz") and not packed:
        raise ResourceError(f"{path} is not gzip")
    with gzip.open(path, "rt", encoding="utf-8") if packed else open(path, encoding="utf-8") as f:
        return f.readline().rstrip("\r\n")


def check(path: str, role: str, complete: bool = False) -> None:
    """Raise unless the file exists, isn't empty and has the role's exact header; ``complete`` unpacks it to its end."""
    if not os.path.isfile(path) or not os.path.getsize(path):
        raise ResourceError(f"{path} is missing or empty")
    try:
        header = first_line(path)
        if header != HEADERS[role]:
            raise ResourceError(f"{path} has another header than {role}")
        if complete and path.endswith(".gz"):
            with gzip.open(path, "rb") as f:
                while f.read(1 << 20):
                    pass
    except (OSError, EOFError, zlib.error, UnicodeDecodeError) as e:
        raise ResourceError(f"{path} can't be read: {e}") from e


def valid(path: str, role: str, complete: bool = False) -> bool:
    try:
        check(path, role, complete)
    except ResourceError:
        return False
    return True


def candidates(cache: str, role: str) -> list[str]:
    """The role's file names in order of preference: packed, then plain."""
    name = filename(role)
    return [f"{cache}/{name}", f"{cache}/{name.removesuffix('.gz')}"]


def find(cache: str, role: str) -> str | None:
    return next((p for p in candidates(cache, role) if valid(p, role)), None)


def scan(spark: SparkSession, path: str, role: str) -> DataFrame:
    """The file as a DataFrame; a line that doesn't fit the schema fails the scan."""
    sep = " " if role == "protein_links" else "\t"
    return spark.read.schema(SCHEMAS[role]).csv(path, sep=sep, header=True, quote="", mode="FAILFAST", enforceSchema=True)


def terms(spark: SparkSession, path: str) -> DataFrame:
    """Distinct terms of the species; none at all is an error."""
    out = scan(spark, path, "enrichment_terms").where(F.col("id").rlike(f"^{SPECIES}\\.")).distinct()
    if out.isEmpty():
        raise ResourceError(f"{path} has no terms of species {SPECIES}")
    return out


def to_parquet(df: DataFrame, path: str, sort: str | None = None) -> DataFrame:
    """Written once, ordered by a column so that row groups can be skipped."""
    (df.sortWithinPartitions(sort) if sort else df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def url(role: str, species: int = SPECIES, version: str = VERSION, base: str = DOWNLOADS) -> str:
    """The address of a role's packed file."""
    return f"{base}/{FILES[role]}.v{version}/{filename(role, species, version)}"


def manifest(spark: SparkSession, cache: str, species: int = SPECIES, version: str = VERSION, base: str = DOWNLOADS) -> DataFrame:
    """(role, filename, path, exists, size, valid, species, version, url) of the four resources; another species or version raises."""
    rows = []
    for role in FILES:
        address = url(role, species, version, base)
        path = find(cache, role) or candidates(cache, role)[0]
        exists = os.path.isfile(path)
        rows.append((role, os.path.basename(path), path, exists, os.path.getsize(path) if exists else None, valid(path, role), species, version, address))
    return spark.createDataFrame(rows, "role string, filename string, path string, exists boolean, size long, valid boolean, species int, version string, url string")


def offline(role: str, target: str) -> None:
    raise ResourceError(f"{role} is not in the cache and nothing is fetched")


def ensure(cache: str, roles: list[str], fetch: Callable[[str, str], None] = offline) -> dict[str, str]:
    """Paths of valid files; what is missing is fetched beside its place, checked in full, then renamed."""
    out = {}
    for role in roles:
        path = find(cache, role)
        if path is None:
            os.makedirs(cache, exist_ok=True)
            path = candidates(cache, role)[0]
            with tempfile.NamedTemporaryFile(prefix=f".{os.path.basename(path)}.part-", suffix=".gz", dir=cache, delete=False) as f:
                part = f.name
            try:
                fetch(role, part)
                check(part, role, complete=True)
                shutil.move(part, path)
            finally:
                if os.path.exists(part):
                    os.remove(part)
            check(path, role)
        out[role] = path
    return out


@dataclass
class Resources:
    """The four tables under one threshold."""

    proteins: DataFrame
    aliases: DataFrame
    links: DataFrame
    terms: DataFrame | None
    threshold: int

    @classmethod
    def open(cls, spark: SparkSession, cache: str, threshold: int = 400, enrichment: bool = True, fetch: Callable[[str, str], None] = offline) -> Resources:
        if not isinstance(threshold, int) or not 1 <= threshold <= 1000:
            raise ResourceError("the threshold is a whole number from 1 to 1000")
        p = ensure(cache, list(FILES) if enrichment else list(FILES)[:3], fetch)
        return cls(scan(spark, p["protein_info"], "protein_info"), scan(spark, p["protein_aliases"], "protein_aliases"), scan(spark, p["protein_links"], "protein_links"), terms(spark, p["enrichment_terms"]) if enrichment else None, threshold)
