"""What a run works with: its settings, its tables, and what is kept of it so that a run that was killed can go on."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators import dedup, families, gates, labels
from siftwell.operators.store import delete, exists, hadoop, kept, read_text, write_text
from siftwell.plans import prompts
from siftwell.plans.asks import ASKS


@dataclass(frozen=True)
class Settings:
    """What a run may change. labellers maps steps of ASKS to functions on (key, payload) pairs; without any, no step is asked."""

    dialect: str = "auto"
    gate: gates.Gate = gates.Gate()
    min_chain_coverage: float = 0.5
    max_bad_lines: float = 0.01
    precheck: bool = True
    segmentation: bool = True
    family_review: bool = True
    post: bool = True
    dedup_enabled: bool = True
    dedup_mode: str = "semantic"
    threshold: float = dedup.THRESHOLD
    candidate_threshold: float = families.CANDIDATE_THRESHOLD
    max_candidates: int = families.MAX_CANDIDATES
    translate: bool = True
    verify_rounds: int = 1
    labellers: dict[str, labels.Labeller] = field(default_factory=dict)
    model: str = "offline"
    generation: str = "1"
    label_path: str | None = None
    log_path: str | None = None
    prompt_folder: str | None = None
    stages: tuple[str, ...] | None = None
    diagnostics: bool = True
    resume: bool = True


def source_hash() -> str:
    """A hash of this package's sources: what an earlier version has concluded is not used again."""
    out = hashlib.sha256()
    root = Path(__file__).resolve().parent.parent
    for path in sorted(x for x in root.rglob("*.py") if "llm" not in x.relative_to(root).parts):
        out.update(path.read_bytes())
    return out.hexdigest()[:16]


@dataclass
class State:
    """tables are named by what they hold; stats become the summary; dropped are rows that a stage has left out, by diagnostics file."""

    spark: SparkSession
    source: str
    folder: str
    settings: Settings
    tables: dict[str, DataFrame] = field(default_factory=dict)
    stats: dict[str, object] = field(default_factory=dict)
    stage: str = ""
    fresh: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.saved = f"{self.folder}/state/{self.fingerprint()}"

    def fingerprint(self) -> str:
        """A hash of the settings, prompts, sources and input files: state of a run that differs in one of these is not used."""
        said = {k: v for k, v in asdict(self.settings).items() if k not in ("labellers", "resume", "diagnostics")}
        target, fs = hadoop(self.spark, self.source)
        files = [y for x in fs.globStatus(target) or [] for y in (fs.listStatus(x.getPath()) if x.isDirectory() else [x])]
        listed = sorted((str(x.getPath()), x.getLen(), x.getModificationTime()) for x in files)
        material = [said, sorted(self.settings.labellers), prompts.fingerprint(self.settings.prompt_folder), source_hash(), listed]
        return hashlib.sha256(json.dumps(material, sort_keys=True, default=str).encode()).hexdigest()[:24]

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Stores a table of the running stage under its name."""
        out = kept(df, f"{self.saved}/{self.stage}/{name}")
        self.tables[name] = out
        self.fresh.append(name)
        return out

    def done(self, stage: str) -> None:
        """Marks a stage as complete, with all that it has kept and counted."""
        schemas = {n: self.tables[n].schema.json() for n in self.fresh}
        write_text(self.spark, f"{self.saved}/{stage}.json", json.dumps({"tables": schemas, "stats": self.stats}, default=str))
        self.fresh = []

    def restored(self, stage: str) -> bool:
        """Takes up what an earlier run with the same fingerprint has kept of a stage, if it was complete."""
        from pyspark.sql.types import StructType

        if not self.settings.resume or not exists(self.spark, f"{self.saved}/{stage}.json"):
            return False
        said = json.loads(read_text(self.spark, f"{self.saved}/{stage}.json"))
        for name, schema in said["tables"].items():
            self.tables[name] = self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{self.saved}/{stage}/{name}")
        self.stats |= said["stats"]
        return True

    def forget(self) -> None:
        """Deletes the state of this run and of all others of the folder; labels stay."""
        delete(self.spark, f"{self.folder}/state")

    def can_ask(self, *steps: str) -> bool:
        return any(self._labeller(s) for s in steps)

    def _labeller(self, step: str) -> labels.Labeller | None:
        known = self.settings.labellers
        short = {"classify_complex": "classify", "classify_normal": "classify", "classify_normal_after_verify": "classify_normal", "verify_again": "verify"}
        while step not in known and step in short:
            step = short[step]
        return known.get(step)

    def labelled(self, step: str, asked: DataFrame, name: str | None = None, variant: str = "") -> DataFrame:
        """asked (payload, ...) with a struct column name (by default step): the cleaned label, null without a valid one.

        variant tells apart askings of one payload by the same step.
        """
        ask, labeller, name = ASKS[step], self._labeller(step), name or step
        if labeller is None:
            none = ask.read(asked.sparkSession.createDataFrame([], "label string"), "x").schema["x"].dataType
            return asked.withColumn(name, F.lit(None).cast(none))
        generation = f"{self.settings.generation}-{prompts.fingerprint(self.settings.prompt_folder)}-{source_hash()}"
        table = labels.LabelTable(self.spark, self.settings.label_path or f"{self.folder}/labels", generation)
        keyed = asked.withColumn("key", labels.label_key(step + variant, self.settings.model, generation, F.col("payload")))
        return ask.read(labels.labelled(keyed, table, step + variant, labeller, ask.checked), name).drop("key", "label")
