"""Settings of sites from YAML and environment files, as tables and defaults."""

from __future__ import annotations

import os

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S, _L = T.StringType(), T.ArrayType(T.StringType())
#: A map whose order counts: the first category is the default, and runs can be resumed from one.
_M = T.ArrayType(T.StructType([T.StructField("category", T.StringType()), T.StructField("archive_url", T.StringType())]))
SITE = {
    "name": _S, "description": _S, "slug": _S, "archive_url": _S, "archive_urls": _M, "archive_selector": _S, "content_selector": _S, "thumbnail_selector": _S,
    "pagination_type": _S, "pagination_param": _S, "pagination_increment": T.LongType(), "delay": _S, "timeout": T.LongType(), "max_pages": T.LongType(),
    "use_proxy": T.BooleanType(), "force_engine": _S, "output_format": _S, "resume": T.BooleanType(), "log_level": _S,
}
CLEANING = {"name": _S, "domain": _S, "feature_image_selector": _S, "main_text_selector": _S, "title_removal_keywords": _L, "text_removal_keywords": _L, "removal_classes": _L}
CLEANING_DEFAULTS = {"domain": "News", "feature_image_selector": "", "main_text_selector": "", "title_removal_keywords": [], "text_removal_keywords": [], "removal_classes": []}


def load_yaml(path: str) -> dict:
    """The file's settings; empty if it is missing or can't be read as YAML."""
    try:
        with open(path, encoding="utf-8") as f:
            return yaml.safe_load(f) or {}
    except (OSError, yaml.YAMLError):
        return {}


def _as(kind: T.DataType, v):
    if v is None:
        return None
    if kind == _S:
        return str(v)
    return [(str(k), str(x)) for k, x in v.items()] if kind == _M else list(map(str, v)) if kind == _L else bool(v) if kind == T.BooleanType() else int(v)


def site_table(spark: SparkSession, settings: dict, kinds: dict[str, T.DataType] = SITE) -> DataFrame:
    """One row per site: its own settings over the file's defaults; lists are replaced, not joined."""
    rows = []
    for site, own in (settings.get("sites") or {}).items():
        merged = {**(settings.get("defaults") or {}), **(own or {})}
        rows.append((site, *(_as(kind, merged.get(k)) for k, kind in kinds.items())))
    schema = T.StructType([T.StructField("site", _S), *(T.StructField(k, kind) for k, kind in kinds.items())])
    return spark.createDataFrame(rows, schema)


_text = lambda v: v or None
_whole = lambda v: int(v) if v and v.isdigit() else None
_number = lambda v: float(v) if v else None
_flag = lambda v: (v or "").lower() in ("true", "1", "yes", "on")
# Settings of an environment file, what they are if they aren't there, and how they are read. None: required.
ENV = {
    "slug": None, "archive_url": None, "archive_selector": None, "content_selector": None,
    "pagination_type": ("none", _text), "pagination_param": (None, _text), "thumbnail_selector": ("img", _text), "delay": ("1.0", _text), "timeout": ("30", _number), "max_pages": (None, _whole),
    "use_proxy": ("false", _flag), "force_engine": (None, _text), "log_level": ("INFO", _text), "output_format": ("ndjson", _text), "resume": ("false", _flag),
}


def load_env(path: str, prefix: str = "SCRAPER_") -> dict | None:
    """Settings from KEY=value lines, by lower-case names without the prefix; None if the file or a required one is missing."""
    if not os.path.exists(path):
        return None
    found: dict[str, str] = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            key, sep, value = line.strip().removeprefix("export ").partition("=")
            if sep and not key.startswith("#") and key.strip().startswith(prefix):
                found[key.strip().removeprefix(prefix).lower()] = value.strip().strip("\"'")
    out: dict = {}
    for name, spec in ENV.items():
        if spec is None and not found.get(name):
            return None
        out[name] = found[name] if spec is None else spec[1](found.get(name, spec[0]))
    return out
