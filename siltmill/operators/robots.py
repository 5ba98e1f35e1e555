"""Which URLs a site's robots rules allow, as a join with a table of rules."""

from __future__ import annotations

from functools import lru_cache
from urllib.robotparser import RobotFileParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltmill.functions.urls import url_host


@lru_cache(maxsize=4096)
def _rules(text: str) -> RobotFileParser:
    parser = RobotFileParser()
    parser.parse(text.splitlines())
    return parser


def may_fetch(url: str | None, rules: str | None, agent: str = "*") -> bool:
    """Whether rules allow a URL; without rules everything is allowed."""
    return not rules or _rules(rules).can_fetch(agent, url or "")


def allowed(urls: DataFrame, rules: DataFrame, agent: str = "*") -> DataFrame:
    """Rows of (url, ...) that the rules (host, rules) of their host allow; hosts without rules allow all."""
    hosts = rules.select(F.col("host").alias("__host"), F.col("rules").alias("__rules")).dropDuplicates(["__host"])
    joined = urls.join(hosts, url_host(F.col("url")) == F.col("__host"), "left")
    return joined.where(F.udf(may_fetch, T.BooleanType(), useArrow=True)("url", "__rules", F.lit(agent))).select(*urls.columns)
