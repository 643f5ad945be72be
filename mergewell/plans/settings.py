"""Settings of a run, and the fingerprints by which its tables know whether they still hold."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import SparkSession

from mergewell.operators.retrieval import channels
from mergewell.operators.vectors import Channel

#: What a session gets by the memory of one executor: partitions of a shuffle for each core and rows of an Arrow batch.
PROFILES = {
    "16gb": {"shuffle_partitions_per_core": 8, "arrow_rows": 5_000},
    "32gb": {"shuffle_partitions_per_core": 4, "arrow_rows": 10_000},
    "64gb": {"shuffle_partitions_per_core": 2, "arrow_rows": 20_000},
}
PREFIX = "MERGEWELL_"


@dataclass(frozen=True)
class Settings:
    """Where a run reads and writes, and what decides its results.

    ``profile``, ``shuffle_partitions`` and ``arrow_rows`` change speed only and
    are in no fingerprint; every other value below ``data`` and ``work`` is in
    those of the stages that depend on it.
    """

    data: str = "data"
    work: str = "work"
    profile: str = "32gb"
    shuffle_partitions: int = 0
    arrow_rows: int = 0
    dev: bool = False
    dev_share: float = 0.02
    dev_distractors: float = 0.1
    per_query: int = 60
    top_k: str = ""  # "addr=40,name=10": other numbers of targets for a query, by channel
    folds: int = 5
    stage0_share: float = 0.15
    train_share: float = 1.0
    rounds0: int = 100
    rounds: int = 100
    depth: int = 6
    seed: int = 42
    least_p: float = 0.01

    @classmethod
    def of(cls, env: Mapping[str, str] | None = None, **overrides: object) -> Settings:
        """Defaults, then the profile, then ``MERGEWELL_*`` of the environment, then ``overrides``."""
        env = os.environ if env is None else env
        kinds = {f.name: type(f.default) for f in fields(cls)}
        given: dict[str, object] = {}
        for name, kind in kinds.items():
            if (text := env.get(PREFIX + name.upper())) is not None:
                given[name] = text.lower() in ("1", "true", "yes") if kind is bool else kind(text)
        given |= overrides
        if unknown := set(given) - set(kinds):
            raise ValueError(f"unknown settings {sorted(unknown)}")
        profile = str(given.get("profile", cls.profile))
        if profile not in PROFILES:
            raise ValueError(f"unknown profile {profile}, known are {sorted(PROFILES)}")
        return replace(cls(), **({"arrow_rows": PROFILES[profile]["arrow_rows"]} | given))

    @property
    def channels(self) -> tuple[Channel, ...]:
        other = dict(x.split("=") for x in self.top_k.split(",") if x)
        return tuple(replace(c, top_k=int(other.get(c.name, c.top_k))) for c in channels())

    @property
    def root(self) -> str:
        """Tables of a slice for development are apart from those of a whole run."""
        return f"{self.work}/dev" if self.dev else self.work

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def configure(self, spark: SparkSession) -> int:
        """Sets what the profile says for this session; returns the number of shuffle partitions."""
        cores = spark.sparkContext.defaultParallelism
        parts = self.shuffle_partitions or PROFILES[self.profile]["shuffle_partitions_per_core"] * cores
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", self.arrow_rows or PROFILES[self.profile]["arrow_rows"])
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        return parts


def fingerprint(value: object) -> str:
    """16 hex digits of the SHA-256 of a value as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()[:16]


#: What each stage's result depends on besides the stage before it.
DEPENDS = {
    "normalize": ("dev", "dev_share", "dev_distractors"),
    "candidates": ("channels",),
    "prune": ("per_query", "stage0_share", "rounds0", "depth", "seed"),
    "features": (),
    "stage1": ("folds", "train_share", "rounds", "depth", "seed"),
    "stage2": ("folds", "train_share", "rounds", "depth", "seed"),
    "decision": ("least_p",),
    "predict": (),
    "submit": (),
}


def stage_hashes(settings: Settings, version: int = 1) -> dict[str, str]:
    """A fingerprint for each stage: its own settings and the fingerprint of the stage before it."""
    own = asdict(settings) | {"channels": [asdict(c) for c in settings.channels]}
    out, last = {}, ""
    for stage, names in DEPENDS.items():
        last = out[stage] = fingerprint([stage, version, last, {n: own[n] for n in names}])
    return out


def safe_name(text: str) -> str:
    """A name for files: letters, digits and dots, everything else as one underscore; never empty."""
    return re.sub(r"[^A-Za-z0-9.]+", "_", text).strip("_.") or "none"
