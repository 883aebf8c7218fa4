"""Settings of a run: a YAML file over defaults."""

from __future__ import annotations

import copy

DEFAULTS = {
    "seed": 42,
    "paths": {"dataset_dir": "dataset", "artifacts_dir": "artifacts", "output_dir": "output", "reports_dir": "reports"},
    "sample": {"frac": 0.2, "seed": 42},
    "train_countries": [],
    "blocking": {"cap": 40, "b1": 20, "b2": 15, "b3": 20, "b4": 10, "b5": 25, "gate_k": 40, "gate_recall": 0.97},
    "models": {"seeds": [42], "n_folds": 5},
    "decide": {"tau_gate": 0.5, "tau_pair": 0.5, "tau_s2": None, "tau_s3": None, "alpha": 0.0, "delta_unseen": 0.0, "one_owner": False, "min_p": 0.2},
}


def merged(base: dict, over: dict) -> dict:
    out = copy.deepcopy(base)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(out.get(key), dict) and isinstance(value, dict) else value
    return out


def load(path: str | None = None) -> dict:
    """The defaults under the file's values; keys that nothing reads are kept and have no effect."""
    if path is None:
        return copy.deepcopy(DEFAULTS)
    import yaml

    with open(path, encoding="utf-8") as text:
        return merged(DEFAULTS, yaml.safe_load(text) or {})
