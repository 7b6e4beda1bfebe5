"""Settings of a run: each step has a switch and its parameters."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Step:
    run: bool = True
    parameters: dict = field(default_factory=dict)


@dataclass(frozen=True)
class RunConfig:
    """n_rounds, n_fovs and the pattern of their names; steps by name. subset picks fields of view: a list, an inclusive range
    (start, end) or a random number of them with a seed."""

    dataset_id: str = ""
    n_rounds: int = 1
    n_fovs: int = 1
    fov_pattern: str = "Position%03d"
    ref_round: str = "round1"
    steps: dict[str, Step] = field(default_factory=dict)
    subset_list: tuple[int, ...] = ()
    subset_range: tuple[int, int] | None = None
    subset_random: tuple[int, int] | None = None

    @classmethod
    def from_json(cls, text: str) -> RunConfig:
        raw = json.loads(text)
        known = {f.name for f in dataclasses.fields(cls)}
        if unknown := set(raw) - known:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        for k in ("subset_list", "subset_range", "subset_random"):
            if raw.get(k) is not None:
                raw[k] = tuple(raw[k])
        raw["steps"] = {k: Step(**v) for k, v in raw.get("steps", {}).items()}
        return cls(**raw)

    def on(self, step: str) -> bool:
        return step in self.steps and self.steps[step].run

    def parameters(self, step: str) -> dict:
        return self.steps[step].parameters if step in self.steps else {}

    def fovs(self) -> list[int]:
        if self.subset_list:
            return list(self.subset_list)
        if self.subset_range:
            return list(range(self.subset_range[0], self.subset_range[1] + 1))
        every = list(range(1, self.n_fovs + 1))
        if self.subset_random:
            import random

            return sorted(random.Random(self.subset_random[1]).sample(every, min(self.subset_random[0], self.n_fovs)))
        return every
