"""Runs a configured chain: ``python -m tracewright CONFIG [--steps ...] [--resume | --force]``."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from .operators import model_stage
from .plans.pipeline import STAGES, Config, PipelineError, Runner, config_value

log = logging.getLogger("tracewright")


def setup_logging(level: str = "INFO", file: str | None = None) -> None:
    """Records with time and level to standard error, and to a file beside it if one is named."""
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stderr)]
    if file:
        handlers.append(logging.FileHandler(file, encoding="utf-8"))
    logging.basicConfig(level=getattr(logging, level.upper(), logging.INFO), format="%(asctime)s %(levelname)s %(name)s: %(message)s", handlers=handlers, force=True)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tracewright", description="Run the steps of a curation chain.")
    out.add_argument("config", help="JSON or YAML file: name, base_input, folder, steps")
    out.add_argument("--steps", help="names or 1-based numbers, comma-separated; the enabled ones if left out")
    again = out.add_mutually_exclusive_group()
    again.add_argument("--resume", action="store_true", help="go on after the last finished step of this configuration")
    again.add_argument("--force", action="store_true", help="forget what earlier runs finished")
    out.add_argument("--drop-invalid", action="store_true", help="pass only valid rows on")
    out.add_argument("--model-url", help="chat server for the model stages; fixed rules stand in if left out (TRACEWRIGHT_MODEL_URL)")
    out.add_argument("--model", help="model that the server is asked for (TRACEWRIGHT_MODEL)")
    out.add_argument("--log-level", help="TRACEWRIGHT_LOG_LEVEL, INFO by default")
    out.add_argument("--log-file")
    return out


def stages_for(url: str | None, model: str) -> dict:
    """The stages, those with a model asking the server at this address."""
    if not url:
        return STAGES
    pii, corrections = (lambda shape: lambda: model_stage.HttpClient(url, model, shape))(model_stage.PII_SHAPE), (lambda shape: lambda: model_stage.HttpClient(url, model, shape))(model_stage.CORRECTION_SHAPE)
    return STAGES | {
        "model_redact": lambda df, **o: model_stage.redact_by_model(df, o.pop("client", pii), **o),
        "corrections": lambda df, **o: model_stage.label_corrections(df, o.pop("client", corrections), model=model, **o),
    }


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    given = parser().parse_args(arguments)
    setup_logging(config_value("TRACEWRIGHT_LOG_LEVEL", given.log_level, default="INFO"), given.log_file)
    try:
        config = Config.load(given.config)
        session = spark or SparkSession.builder.appName(f"tracewright {config.name}").getOrCreate()
        stages = stages_for(config_value("TRACEWRIGHT_MODEL_URL", given.model_url), config_value("TRACEWRIGHT_MODEL", given.model, default="default"))
        counts = Runner(session, config, stages, given.drop_invalid).run(given.steps, given.resume, given.force)
    except (PipelineError, OSError) as e:
        log.error("%s", e)
        return 1
    for c in counts:
        log.info("%s: %s valid, %s invalid", c["stage"], c["n_valid"], c["n_invalid"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
