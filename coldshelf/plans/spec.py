"""The definition of an archive job and its validation."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from coldshelf.sources.endpoints import SourceSpec, check_endpoints, inside
from coldshelf.sources.templates import fixed_folder

Hook = Callable[[DataFrame], DataFrame]

_WHERE_TO = (None, "", "d", "s", "ds")


@dataclass(frozen=True)
class Hooks:
    """User steps.  ``before_delete`` comes first and may only take rows out of the set to
    delete; these are kept, and not copied either.  ``before_insert`` may change the rows on
    their way to the destination; ``after_finish`` sees the job's counters."""

    before_insert: Hook | None = None
    before_delete: Hook | None = None
    after_finish: Callable[[DataFrame], object] | None = None


@dataclass(frozen=True)
class ArchiveSpec:
    source: SourceSpec
    where: str
    dest: SourceSpec | None = None
    file: str | None = None  # folder of archive files, a name template
    file_ts: str | None = None  # column whose time routes rows to files
    output_format: str = "dump"
    header: bool = False
    kept_path: str | None = None  # new folder for the remaining rows
    columns: tuple[str, ...] = ()
    primary_key_only: bool = False
    keys: tuple[str, ...] = ()
    unique_keys: bool = True  # the keys tell rows apart
    chunk_rows: int = 1000
    purge: bool = False
    no_delete: bool = False
    ignore: bool = False
    replace: bool = False
    bulk_insert: bool = False  # load the destination from dump files
    check_columns: bool = True
    verify: bool = True  # compare checksums of the files written, not only row counts
    autoinc_col: str | None = None  # spare the row with its largest value
    analyze: str | None = None
    optimize: str | None = None
    progress: int = 0  # rows between progress marks
    journal: str | None = None  # folder for finished steps; beside kept_path if there is one
    dry_run: bool = False
    hooks: Hooks = field(default_factory=Hooks)

    def validated(self) -> ArchiveSpec:
        """The job with its destination completed, or an error saying what is wrong."""
        dest = check_endpoints(self.source, self.dest)
        rules = [
            (not self.where.strip(), "where must be set"),
            (self.output_format not in ("dump", "csv"), "output format must be dump or csv"),
            (self.analyze not in _WHERE_TO, "analyze must be d, s or ds"),
            (self.optimize not in _WHERE_TO, "optimize must be d, s or ds"),
            (self.chunk_rows < 1, "chunk_rows must be at least 1"),
            (self.progress < 0, "progress must not be negative"),
            (self.bulk_insert and dest is None, "bulk_insert needs a destination"),
            (self.purge and self.no_delete, "purge and no_delete exclude each other"),
            (self.ignore and self.replace, "ignore and replace exclude each other"),
            (
                not (dest or self.file or self.purge),
                "one of dest, file or purge must be given",
            ),
            (
                self.purge and bool(dest or self.file),
                "purge deletes without copying: give neither dest nor file",
            ),
            (
                (self.ignore or self.replace) and not self.keys,
                "ignore and replace need keys",
            ),
            (
                (self.ignore or self.replace) and not self.unique_keys,
                "ignore and replace need unique keys",
            ),
            (self.primary_key_only and not self.keys, "primary_key_only needs keys"),
            (
                not self.no_delete and not self.kept_path,
                "kept_path must be set unless no_delete is",
            ),
        ]
        for broken, message in rules:
            if broken:
                raise ValueError(message)
        self._require_apart(dest)
        return replace(self, dest=dest)

    def _require_apart(self, dest: SourceSpec | None, form=str) -> None:
        """No folder that the job writes may hold, or lie in, the source's folder.

        ``form`` brings paths into one form; a session's file systems know more than the
        text does.
        """
        if not self.source.path:
            return
        written = {
            "dest": dest and dest.path,
            "file": self.file and fixed_folder(self.file),
            "kept_path": self.kept_path,
            "journal": self.journal,
        }
        for name, path in written.items():
            if path and (
                inside(form(path), form(self.source.path)) or name != "file" and inside(form(self.source.path), form(path))
            ):
                raise ValueError(f"{name} must not be a folder of the source: {path}")

    def journal_path(self) -> str | None:
        """Where the job's finished steps are noted, if anywhere."""
        if self.journal:
            return self.journal.rstrip("/")
        return f"{self.kept_path.rstrip('/')}.journal" if self.kept_path and not self.no_delete else None

    def fingerprint(self) -> str:
        """Tells a job from other ones; its hooks, which are code, do not count."""
        return hashlib.sha256(repr(replace(self, hooks=Hooks())).encode()).hexdigest()
