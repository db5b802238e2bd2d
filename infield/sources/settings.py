"""Settings from files on any storage that Spark reads: model definitions, detector thresholds, and overrides of identities."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import fields
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from infield.functions import columns as fx
from infield.operators.insights import THRESHOLDS
from infield.operators.ml import Breakout, Splits


class SettingsError(ValueError):
    """A file that doesn't say what it has to."""


def load(spark: SparkSession, path: str) -> dict[str, Any]:
    """The object of a JSON file, which is read whole: settings are small."""
    texts = [r.value for r in spark.read.text(path, wholetext=True).collect()]
    if len(texts) != 1:
        raise SettingsError(f"{path}: {len(texts)} files instead of one")
    try:
        found = json.loads(texts[0])
    except json.JSONDecodeError as e:
        raise SettingsError(f"{path}: {e}") from e
    if not isinstance(found, dict):
        raise SettingsError(f"{path}: no object")
    return found


def _checked(found: Mapping[str, Any], known: Mapping[str, Any], what: str) -> dict[str, Any]:
    """``found`` with its values in the kinds of ``known``; names that nobody knows and values of another kind are errors."""
    if unknown := sorted(set(found) - set(known)):
        raise SettingsError(f"{what}: unknown {unknown}")
    out = {}
    for name, value in found.items():
        default = known[name]
        numbers = isinstance(default, (int, float)) and isinstance(value, (int, float)) and not isinstance(value, bool)
        lists = isinstance(default, (list, tuple)) and isinstance(value, list)
        flag = isinstance(value, bool) and not isinstance(default, bool)
        if flag or not (numbers or lists or isinstance(value, type(default)) or (isinstance(default, Mapping) and isinstance(value, Mapping))):
            raise SettingsError(f"{what}: {name} is {value!r}")
        out[name] = tuple(value) if isinstance(default, tuple) else value
    return out


def breakout(found: Mapping[str, Any]) -> Breakout:
    """The model's definition; what isn't given is as usual."""
    default = Breakout()
    known = {f.name: getattr(default, f.name) for f in fields(Breakout)}
    try:
        return Breakout(**_checked(found, known, "breakout"))
    except SettingsError:
        raise
    except ValueError as e:
        raise SettingsError(f"breakout: {e}") from e


def splits(found: Mapping[str, Any]) -> Splits:
    given = _checked(found, {"train_end": "", "validation_end": "", "embargo_days": 0}, "splits")
    if lacking := {"train_end", "validation_end", "embargo_days"} - set(given):
        raise SettingsError(f"splits: no {sorted(lacking)}")
    try:
        return Splits(**given)
    except ValueError as e:
        raise SettingsError(f"splits: {e}") from e


def thresholds(found: Mapping[str, Any]) -> dict[str, dict[str, Any]]:
    """The detectors to run, in the order of the file, with their thresholds; those that aren't given are as usual."""
    if unknown := sorted(set(found) - set(THRESHOLDS)):
        raise SettingsError(f"insights: unknown detectors {unknown}")
    return {name: {**THRESHOLDS[name], **_checked(given, THRESHOLDS[name], name)} for name, given in found.items()}


def overrides(spark: SparkSession, path: str) -> DataFrame | None:
    """Identities given by hand, from a CSV file: rows with an id, trimmed, of each source's id the last one by content. None without the file."""
    from pyspark.sql.utils import AnalysisException

    try:
        rows = spark.read.option("header", "true").csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    names = ["entity_type", "source", "source_id", "canonical_id"]
    if lacking := [n for n in names if n not in rows.columns]:
        raise SettingsError(f"{path} lacks {', '.join(lacking)}")
    notes = F.trim("notes") if "notes" in rows.columns else F.lit(None).cast("string")
    given = rows.select(*[F.trim(n).alias(n) for n in names], notes.alias("notes")).where(fx.present("canonical_id") & fx.present("source_id"))
    return given.groupBy("entity_type", "source", "source_id").agg(F.max(F.struct("canonical_id", "notes")).alias("g")).select("entity_type", "source", "source_id", "g.canonical_id", "g.notes")
