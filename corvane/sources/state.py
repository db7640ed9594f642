"""State of a run on the driver: checkpoint logs, manifests, names and paths, rule files and settings.

A log is small next to the data: a line for each row, call and note. The driver
appends to it, Spark reads it back (``tables.log``). Paths are local to the
driver; what executors share goes through Spark's writers.
"""

from __future__ import annotations

import csv
import json
import os
import re
import shutil
from collections.abc import Iterable, Sequence
from datetime import datetime
from pathlib import Path
from typing import Any

# Parts of file names.
STAMP = "%y%m%d%H"
_SUFFIXES = ("_cleaned", "_clean", "_extracted", "_quality", "_results")


class Log:
    """An append-only log of JSON lines that begins with what the run is about."""

    def __init__(self, path: str) -> None:
        self.path = Path(path)
        self.path.parent.mkdir(parents=True, exist_ok=True)

    def append(self, kind: str, **cells: Any) -> None:
        with self.path.open("a", encoding="utf-8") as file:
            file.write(json.dumps({"type": kind, **cells}, ensure_ascii=False) + "\n")

    def reset(self, **about: str) -> None:
        """Starts anew; paths among ``about`` are stored whole."""
        self.path.unlink(missing_ok=True)
        whole = {k: str(Path(v).resolve()) if k.endswith("_path") else v for k, v in about.items()}
        self.append("meta", **whole, started_at=datetime.now().strftime("%Y-%m-%d %H:%M:%S"))

    def entries(self) -> Iterable[dict]:
        """All entries; lines that are no JSON objects are skipped."""
        if not self.path.exists():
            return
        with self.path.open(encoding="utf-8") as file:
            for line in file:
                try:
                    entry = json.loads(line)
                except ValueError:
                    continue
                if isinstance(entry, dict):
                    yield entry

    def about(self) -> dict:
        return next((x for x in self.entries() if x.get("type") == "meta"), {})

    def has_progress(self) -> bool:
        return any(x.get("type") != "meta" for x in self.entries())

    def has_rows(self) -> bool:
        return any(x.get("type") == "row" for x in self.entries())

    def rows(self, rows: Iterable[dict], **cells: Any) -> None:
        for row in rows:
            self.append("row", **cells, data=row)

    def usage(self, tokens: dict[str, int], completed: Sequence[Any] = (), **cells: Any) -> None:
        self.append("usage", **cells, completed_record_ids=list(completed), data=dict(tokens))

    def no_row(self, record_id: int, **cells: Any) -> None:
        self.append("no_row_resolution", **cells, record_id=record_id)

    def batch(self, index: int, rows: Iterable[dict], tokens: dict[str, int], completed: Sequence[Any]) -> None:
        """A batch's rows, then its call with the records that it completes."""
        self.rows(rows, batch_index=index)
        self.usage(tokens, completed, batch_index=index)

    def check(self, **about: str) -> None:
        """Raises an error unless the log is of the same run."""
        found = self.about()
        if not found:
            raise ValueError("there is no log to go on from")
        for key, value in about.items():
            value = str(Path(value).resolve()) if key.endswith("_path") else value
            if str(found.get(key, "")).strip() != value:
                raise ValueError(f"the log is of another {key}")


def write_document(path: str, document: dict | None) -> str:
    """A JSON document; none deletes the file. The path, or the empty text."""
    at = Path(path)
    if not document:
        at.unlink(missing_ok=True)
        return ""
    at.parent.mkdir(parents=True, exist_ok=True)
    at.write_text(json.dumps(document, ensure_ascii=False, indent=2), encoding="utf-8")
    return str(at)


def read_document(path: str) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def failures(batches: Sequence[dict]) -> dict | None:
    """Manifest of batches that failed for good; None without any."""
    if not batches:
        return None
    return {
        "generated_at": datetime.now().strftime("%Y-%m-%d %H:%M:%S"),
        "failed_batch_count": len(batches),
        "failed_record_count": sum(len(b["record_ids"]) for b in batches),
        "batches": list(batches),
    }


def rescue_manifest(output: str, source: str, ids: Iterable[int], **metadata: Any) -> dict | None:
    """Manifest of the records whose population is still to be looked for; None without any."""
    kept = sorted({int(x) for x in ids})
    if not kept:
        return None
    return {
        "source_path": str(Path(source).resolve()), "output_path": str(Path(output).resolve()), "status": "pending",
        "generated_at": datetime.now().strftime("%Y-%m-%d %H:%M:%S"), "record_ids": kept, "metadata": dict(metadata),
    }


def update_manifest(path: str, status: str, **metadata: Any) -> dict:
    """A manifest with another status and more metadata, written back."""
    document = read_document(path)
    document["status"] = status
    document["metadata"] = {**document.get("metadata", {}), **metadata}
    write_document(path, document)
    return document


def sidecar(path: str, ending: str = "_population_rescue.json") -> Path:
    """The file beside another that has its name and an ending."""
    return Path(path).with_name(Path(path).stem + ending)


def copy_sidecar(source: str, target: str) -> str:
    """Copies the manifest beside one file to another's; the path, or the empty text where there is none."""
    own, other = sidecar(source), sidecar(target)
    if not own.exists():
        return ""
    if own.resolve() != other.resolve():
        shutil.copyfile(own, other)
    return str(other)


def newest(folder: str, prefixes: Sequence[str], fallback: str = "", suffix: str = ".xlsx") -> str:
    """The file changed last among those that begin with a prefix; else the fallback."""
    found = [x for x in Path(folder).glob(f"*{suffix}") if x.name.startswith(tuple(prefixes)) and not x.name.startswith("~")]
    return str(max(found, key=lambda x: x.stat().st_mtime)) if found else fallback


def preferred(folder: str, names: Sequence[str], suffix: str = ".txt") -> str:
    """The first name that there is, else the file changed last; empty without any."""
    for name in names:
        if (Path(folder) / name).exists():
            return str(Path(folder) / name)
    return newest(folder, ("",), "", suffix)


def source_stem(path: str) -> str:
    """A source's name without what earlier stages added: their prefix, their suffixes and a time."""
    stem = re.sub(r"^Step\d[A-Z]?_", "", Path(path).stem, flags=re.IGNORECASE)
    changed = True
    while changed:
        shorter = re.sub(r"_\d{8,10}$", "", stem)
        for suffix in _SUFFIXES:
            shorter = shorter.removesuffix(suffix)
        changed, stem = shorter != stem, shorter
    return stem


def run_folder(root: str, source: str, stage: str = "Step1") -> Path:
    """The folder of a source's runs; a folder that already is one is taken as it is."""
    name = f"{stage.lower()}_run_{source_stem(source)}"
    at = Path(root)
    return at if at.name == name else at / stage / name


def run_paths(root: str, source: str, stage: str = "Step1", now: datetime | None = None) -> dict[str, Path]:
    """Where a run writes its cleaned corpus, its table and its quality report."""
    folder, stamp = run_folder(root, source, stage), (now or datetime.now()).strftime(STAMP)
    base = f"{stage}_{source_stem(source)}_{stamp}"
    return {"cleaned": folder / f"{base}_cleaned.txt", "table": folder / f"{base}_extracted.csv", "quality": folder / f"{base}_quality.txt"}


def checkpoint_path(output: str, folder: str | None = None) -> str:
    """The log of an output: the newest that an interrupted run left for the same source, else a new one."""
    at = Path(folder or Path(output).parent)
    stem = source_stem(output)
    return newest(str(at), (f"{stem}_checkpoint", f"{Path(output).stem}_checkpoint"), str(at / f"{Path(output).stem}_checkpoint.jsonl"), ".jsonl")


def with_prefix(path: str, prefix: str) -> str:
    """A path whose file name begins with a prefix."""
    at = Path(path)
    return str(at if at.name.startswith(prefix) else at.with_name(prefix + at.name))


def safe_name(text: str) -> str:
    """Letters, digits, dots, dashes and underlines."""
    return re.sub(r"[^\w.-]+", "_", text.strip()).strip("._") or "output"


def write_csv(path: str, headers: Sequence[str], rows: Iterable[dict], bom: bool = False) -> None:
    """A small table, such as a codebook; ``bom`` for spreadsheet programs."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as file:
        out = csv.DictWriter(file, fieldnames=list(headers), extrasaction="ignore", restval="")
        out.writeheader()
        out.writerows(rows)


def keys(roots: Sequence[str], names: dict[str, str], file: str = "api_keys.json") -> dict[str, str]:
    """Keys of providers from the first file found, else from the environment; placeholders don't count."""
    found: dict[str, str] = {}
    at = next((Path(r) / file for r in roots if (Path(r) / file).exists()), None)
    if at is not None:
        found = {k: str(v).strip() for k, v in json.loads(at.read_text(encoding="utf-8")).items()}
    found = {k: v for k, v in found.items() if v and not v.startswith("PASTE_")}
    return {provider: found.get(provider) or os.environ.get(variable, "") for provider, variable in names.items()}
