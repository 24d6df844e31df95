"""Predicates and labels on relative paths, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What is left out of a run.
EXCLUDED_NAMES = ("setup.py", "conf.py")
EXCLUDED_PREFIX = "test_"
EXCLUDED_SUFFIX = "_test.py"
EXCLUDED_DIRS = ("tests", "test")
VERSION_CONTROL_DIR = ".git"


def parts(path: Column) -> Column:
    return F.split(path, "/")


def path_order(path: Column) -> Column:
    """Sort key of paths: part by part, so a folder's files stand together whatever its name."""
    return parts(path)


def normalise(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def in_version_control(path: Column) -> Column:
    return F.array_contains(parts(path), VERSION_CONTROL_DIR)


def is_excluded(path: Column) -> Column:
    """True for set-up files and for tests, by file name or by a parent folder."""
    pieces = parts(path)
    name = F.element_at(pieces, -1)
    folders = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return (
        name.isin(*EXCLUDED_NAMES)
        | name.startswith(EXCLUDED_PREFIX)
        | name.endswith(EXCLUDED_SUFFIX)
        | F.arrays_overlap(folders, F.array(*[F.lit(d) for d in EXCLUDED_DIRS]))
    )


def exclusion_reason(path: Column) -> Column:
    """Display label; any 'test' in the path counts, so it is looser than the rule."""
    return F.when(F.lower(path).contains("test"), "[test dir]").otherwise("[name match]")


def top_dir(path: Column) -> Column:
    """First path component; the file name itself for a file at the root."""
    return F.element_at(parts(path), 1)


def logical_path(repository: str, rel_path: Column) -> Column:
    """Path that does not depend on where the sources were read from."""
    return F.concat(F.lit(f"{repository}/"), rel_path)


def relative_path(repository: str, file_path: Column) -> Column:
    return F.substring(file_path, len(repository) + 2, 1_000_000_000)


def shorten(text: Column, limit: int, keep: int) -> Column:
    """The last ``keep`` characters behind dots when longer than ``limit``."""
    return F.when(
        F.char_length(text) > limit, F.concat(F.lit("..."), F.right(text, F.lit(keep)))
    ).otherwise(text)
