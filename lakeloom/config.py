"""Settings: defaults, overridden by a JSON file, overridden by command-line values."""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict, dataclass, field, fields, replace
from pathlib import Path

GIB = 1024**3


@dataclass(frozen=True)
class Config:
    train_split: float = 0.8
    quality_threshold: float = 4.0
    black_threshold: float = 0.1
    min_dimension: int = 128
    strict_ground_truth: bool = False
    enable_dedup: bool = True
    vetting: str = "literal"
    normalize_votes: bool = True
    n_style_clusters: int = 16
    seed: int = 42
    max_size_gb: float = 150.0
    min_size_gb: float = 6.0
    name_prefix: str = ""
    name_suffix: str = "Large"
    max_files_per_trigger: int = 100
    model: str | None = None
    #: Paths of score tables by format: ava, aadb, koniq, spaq, tid, live, csiq.
    ground_truth: dict = field(default_factory=dict)
    #: Names of registered plug-ins by kind: scorer, labeler, captioner, coder.
    models: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | None = None, overrides: dict | None = None) -> Config:
        """Unknown keys are ignored; a missing file counts as empty; an override of None keeps the value below it."""
        known = {f.name for f in fields(cls)}
        out = cls()
        if path and Path(path).exists():
            out = replace(out, **{k: v for k, v in json.loads(Path(path).read_text()).items() if k in known})
        return replace(out, **{k: v for k, v in (overrides or {}).items() if k in known and v is not None})

    def as_dict(self) -> dict:
        return asdict(self)


def parse_args(argv: list[str]) -> dict:
    """Command-line flags; unknown ones are ignored."""
    p = argparse.ArgumentParser(prog="lakeloom")
    p.add_argument("command", nargs="?", default="compile", choices=["compile", "reduce", "cleanup", "status", "acquire"])
    p.add_argument("--manifest")
    p.add_argument("--config")
    p.add_argument("--model")
    p.add_argument("--suffix", dest="name_suffix")
    p.add_argument("--raw")
    p.add_argument("--out")
    p.add_argument("--export")
    p.add_argument("--max-gb", type=float, dest="max_size_gb")
    p.add_argument("--no-vetting", action="store_const", const="pass_through", dest="vetting")
    p.add_argument("--strict", action="store_const", const=True, dest="strict_ground_truth")
    return vars(p.parse_known_args(argv)[0])
