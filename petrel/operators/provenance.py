"""What a run says of itself: software, inputs, configuration, outputs, and whether a published folder bears it out."""

from __future__ import annotations

import json
import os
import platform
import re
import subprocess
from datetime import datetime, timezone
from importlib import metadata

from petrel.operators.canonical import SCHEMAS
from petrel.sources import resources, sinks

# The manifest's sections, and what a file of each role is.
SECTIONS = ["manifest_schema_version", "generated_at_utc", "software", "runtime", "schemas", "input", "analysis", "summary", "outputs", "privacy"]
MANIFEST_VERSION = "1.0.0"
FILE_SCHEMAS = {"analytical_report": SCHEMAS["analytical_workbook"], "technical_report": "1.0.0", "string_links": "1.0.0", "graphml": SCHEMAS["graphml"]}
PACKAGES = ("pyspark", "py4j", "pyarrow", "pandas", "numpy")
UNKNOWN = "not_available"


def package_versions(names: tuple[str, ...] = PACKAGES) -> dict[str, str]:
    out = {}
    for n in names:
        try:
            out[n] = metadata.version(n)
        except metadata.PackageNotFoundError:
            out[n] = UNKNOWN
    return out


def git_state(root: str) -> dict[str, object]:
    """Commit, branch and cleanliness of a working tree, or that there is none."""

    def ask(*words: str) -> str | None:
        try:
            return subprocess.run(["git", "-C", root, *words], capture_output=True, text=True, timeout=20, check=True).stdout.strip()
        except (OSError, subprocess.SubprocessError):
            return None

    commit = ask("rev-parse", "HEAD")
    if not commit:
        return {"git_commit": UNKNOWN, "git_branch": UNKNOWN, "working_tree_clean": None, "git_metadata_source": UNKNOWN}
    return {"git_commit": commit, "git_branch": ask("rev-parse", "--abbrev-ref", "HEAD") or UNKNOWN, "working_tree_clean": ask("status", "--porcelain") == "", "git_metadata_source": "git"}


def file_metadata(files: dict[str, str], versions: dict[str, str] = FILE_SCHEMAS) -> list[dict]:
    """Role, name, schema version, size and digest of files by role; each must be there and hold something."""
    out = []
    for role, path in files.items():
        if not os.path.isfile(path) or not os.path.getsize(path):
            raise ValueError(f"{role}: {os.path.basename(path)} is missing or empty")
        out.append({"role": role, "name": os.path.basename(path), "schema_version": versions.get(role, UNKNOWN), "size": os.path.getsize(path), "sha256": sinks.sha256(path)})
    return out


def resource_summary(cache: str) -> list[dict]:
    """Role, name and size of the cache's files; digests of files that large are not taken in each run."""
    found = {role: resources.find(cache, role) for role in resources.FILES}
    return [{"role": r, "name": os.path.basename(p) if p else UNKNOWN, "size": os.path.getsize(p) if p else 0, "available": p is not None} for r, p in found.items()]


def build(engine: str, version: str, root: str, case: str, analysis: dict, summary: dict, outputs: list[dict], inputs: dict | None = None) -> dict:
    """The manifest's sections."""
    return {
        "manifest_schema_version": MANIFEST_VERSION,
        "generated_at_utc": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "software": {"name": engine, "version": version, **git_state(root)},
        "runtime": {"python_version": platform.python_version(), "platform": platform.machine(), "operating_system": platform.system(), "package_versions": package_versions()},
        "schemas": SCHEMAS,
        "input": {"case_id": case, "case_id_source": "explicit_case_id", **(inputs or {})},
        "analysis": analysis,
        "summary": summary,
        "outputs": outputs,
        "privacy": {"absolute_paths_in_manifest": False, "user_names_in_manifest": False},
    }


def checks(manifest: dict, folder: str) -> list[tuple[str, str]]:
    """(check_id, status): sections, versions, outputs against the folder, and that nothing private is told."""
    text, outputs = json.dumps(manifest), manifest.get("outputs", [])
    path = lambda x: f"{folder}/{x['name']}"
    there = all(os.path.isfile(path(x)) for x in outputs)
    commit = manifest.get("software", {}).get("git_commit", "")
    found = {
        "manifest_sections_present": set(SECTIONS) <= set(manifest),
        "manifest_schema_version_supported": manifest.get("manifest_schema_version") == MANIFEST_VERSION,
        "generated_at_is_utc": bool(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", str(manifest.get("generated_at_utc")))),
        "software_version_is_semantic": bool(re.fullmatch(r"\d+\.\d+\.\d+", str(manifest.get("software", {}).get("version")))),
        "git_commit_is_valid": commit == UNKNOWN or bool(re.fullmatch("[0-9a-f]{40}", commit)),
        "schema_versions_are_pinned": manifest.get("schemas") == SCHEMAS,
        "output_roles_are_unique": len({x["role"] for x in outputs}) == len(outputs) > 0,
        "output_names_are_base_names": all(os.path.basename(x["name"]) == x["name"] for x in outputs),
        "outputs_exist": there,
        "output_sizes_agree": there and all(os.path.getsize(path(x)) == x["size"] for x in outputs),
        "output_digests_agree": there and all(sinks.sha256(path(x)) == x["sha256"] for x in outputs),
        "output_schema_versions_agree": all(x["schema_version"] == FILE_SCHEMAS.get(x["role"], UNKNOWN) for x in outputs),
        "no_absolute_paths": not re.search(r'"(/|[A-Za-z]:\\\\|file:)[^"]*"', text),
        "input_file_name_privacy_is_valid": "file" not in manifest.get("input", {}),
        "case_id_privacy_is_valid": manifest.get("input", {}).get("case_id_source") == "explicit_case_id",
        "privacy_is_declared": manifest.get("privacy", {}).get("absolute_paths_in_manifest") is False,
    }
    return [(k, "PASS" if v else "FAIL") for k, v in found.items()]


def write(path: str, manifest: dict) -> None:
    """The manifest beside its outputs; a failed check raises before anything is written."""
    failed = [k for k, v in checks(manifest, os.path.dirname(path)) if v == "FAIL"]
    if failed:
        raise ValueError(f"provenance: failed checks: {', '.join(failed)}")
    sinks.write_manifest(path, manifest)
