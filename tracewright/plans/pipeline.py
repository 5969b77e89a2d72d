"""Curation runs: configured stages in order, each checkpointed, validated and resumable.

A stage is a function from DataFrame to DataFrame; its output is Parquet in the
run's folder and is the only thing a later stage, or a resumed run, reads.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators import extract, model_stage, redact, score, sessionize, shape, validate
from ..sources import readers, writers

#: What may stand for a stage's input besides a path: the run's base input, the output before it.
BASE, PREVIOUS = "{base}", "{prev_output}"


class PipelineError(RuntimeError):
    """A run that can't go on."""


@dataclass
class Step:
    name: str
    stage: str
    input: str = PREVIOUS
    output: str = ""
    enabled: bool = True
    limit: int | None = None
    options: dict[str, Any] = field(default_factory=dict)


@dataclass
class Config:
    name: str
    base_input: str
    folder: str
    steps: list[Step]

    @classmethod
    def load(cls, source: str | dict) -> Config:
        """From a dict or a JSON or YAML file; a missing or unknown key is a PipelineError."""
        if isinstance(source, str):
            with open(source) as f:
                text = f.read()
            try:
                source = json.loads(text)
            except ValueError:
                try:
                    import yaml
                except ModuleNotFoundError as e:
                    raise PipelineError("a YAML config needs PyYAML") from e
                source = yaml.safe_load(text)
        try:
            data = dict(source)
            return cls(data["name"], data["base_input"], data["folder"], [s if isinstance(s, Step) else Step(**s) for s in data["steps"]])
        except (KeyError, TypeError) as e:
            raise PipelineError(f"bad config: {e}") from e

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, default=str).encode()).hexdigest()


def _sessions(df: DataFrame, **options: Any) -> DataFrame:
    order = options.get("order", ["ord"])
    return sessionize.longest_per_session(sessionize.sessionize(df, *order), *order)


#: Stage functions; tests and users may add their own to a copy.
STAGES: dict[str, Callable[..., DataFrame]] = {
    "extract": lambda df, **o: extract.extract_traces(df, **o),
    "examples": lambda df, source="base", **o: shape.add_trace_ids(shape.to_examples(df, **o), source),
    "sessionize": _sessions,
    "redact": lambda df, **_: redact.redact_traces(df),
    "model_redact": lambda df, **o: model_stage.redact_by_model(df, o.pop("client", model_stage.RuleClient), **o),
    "score": lambda df, **_: score.score_complexity(df),
    "corrections": lambda df, **o: model_stage.label_corrections(df, o.pop("client", model_stage.RuleClient), **o),
}


#: Stages whose invalid rows never reach the next one.
EXCLUDING = frozenset({"model_redact"})


def select_steps(steps: list[Step], wanted: str | None) -> list[Step]:
    """Enabled steps, or those named by name or 1-based number, comma-separated, in their order.

    Unknown names are ignored; a step that is named runs even if it is disabled.
    """
    if not wanted:
        return [s for s in steps if s.enabled]
    names = {x.strip() for x in wanted.split(",")}
    return [s for k, s in enumerate(steps, 1) if s.name in names or str(k) in names]


class Runner:
    """One configured chain; ``run`` returns the counts of every step it ran."""

    def __init__(self, spark: SparkSession, config: Config, stages: dict[str, Callable[..., DataFrame]] | None = None, drop_invalid: bool = False):
        self.spark, self.config, self.stages, self.drop_invalid = spark, config, stages or STAGES, drop_invalid
        self.manifest = os.path.join(config.folder, "checkpoint.json")

    def _path(self, step: Step) -> str:
        return step.output or os.path.join(self.config.folder, f"{self.config.steps.index(step) + 1:02d}-{step.stage}")

    def load_checkpoint(self) -> dict | None:
        """The last finished step of this very configuration; None if there is none."""
        text = writers.read_text(self.spark, self.manifest)
        try:
            found = json.loads(text) if text else {}
        except ValueError:
            return None
        return found if found.get("config") == self.config.fingerprint() else None

    def save_checkpoint(self, step: Step, counts: list[dict], output: str) -> None:
        state = {"config": self.config.fingerprint(), "last_step": step.name, "output": output, "counts": counts}
        writers.write_text(self.spark, self.manifest, json.dumps(state))

    def clear_checkpoint(self) -> None:
        writers.delete(self.spark, self.manifest)

    def _input(self, step: Step, last: str | None, first: bool) -> DataFrame:
        if step.input == BASE:
            at = self.config.base_input
            if not at.rstrip("/").endswith((".jsonl", ".json", ".json.gz", ".jsonl.gz")) and self.stages.get(step.stage) is self.stages.get("extract"):
                return readers.read_traffic(self.spark, at)
            df = readers.read_jsonl(self.spark, at)
            return shape.add_trace_ids(df, self.config.name) if first else df
        if step.input == PREVIOUS:
            at = self.config.steps.index(step)
            if last is None and at == 0:
                raise PipelineError(f"{step.name} is the first step and has no output before it")
            path = last or self._path(self.config.steps[at - 1])
        else:
            path = step.input
        try:
            return readers.read_jsonl(self.spark, path) if path.endswith((".jsonl", ".json")) else self.spark.read.parquet(path)
        except Exception as e:
            raise PipelineError(f"{step.name}: its input {path} can't be read") from e

    def run(self, wanted: str | None = None, resume: bool = False, force: bool = False) -> list[dict]:
        if force:
            self.clear_checkpoint()
        steps, last, counts = select_steps(self.config.steps, wanted), None, []
        found = self.load_checkpoint() if resume else None
        if found:
            names = [s.name for s in self.config.steps]
            done = names.index(found["last_step"])
            steps = [s for s in steps if names.index(s.name) > done]
            last, counts = found["output"], found["counts"]
        for k, step in enumerate(steps):
            if step.stage not in self.stages:
                raise PipelineError(f"{step.name}: no stage {step.stage}")
            try:
                df = self._input(step, last, k == 0 and not found)
            except FileNotFoundError as e:
                raise PipelineError(f"{step.name}: no input {e}") from e
            order = [c for c in ("ord", "trace_id") if c in df.columns]
            out = self.stages[step.stage](shape.first_n(shape.by_name(df), step.limit, *order), **step.options)
            path = self._path(step)
            writers.replace_table(out, path)
            written = self.spark.read.parquet(path)
            if step.stage in validate.STAGE_REQUIRED:
                row = validate.validation_counts(written, step.stage).first().asDict()
                if row["n_invalid"]:
                    valid, invalid = validate.split_valid(written, step.stage)
                    writers.quarantine(invalid, os.path.join(self.config.folder, "invalid"), step.stage)
                    if self.drop_invalid or step.stage in EXCLUDING:
                        path += "-valid"
                        writers.replace_table(valid, path)
            else:
                row = {"stage": step.stage, "n_valid": written.count(), "n_invalid": 0}
            counts.append(row)
            last = path
            self.save_checkpoint(step, counts, path)
        writers.write_text(self.spark, os.path.join(self.config.folder, "report.md"), writers.report(counts, self.config.name))
        return counts


def config_value(name: str, given: Any = None, environment: dict | None = None, file: dict | None = None, default: Any = None, kind: type = str) -> Any:
    """A setting: what is given, else the environment's, else the file's, else the default."""
    env = os.environ if environment is None else environment
    value = next((v for v in (given, env.get(name), (file or {}).get(name)) if v is not None), default)
    if kind is bool and isinstance(value, str):
        return value.strip().lower() in ("1", "true", "yes", "on")
    return value if value is None else kind(value)
