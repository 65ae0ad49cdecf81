"""Option defaults of every command, and their precedence: given, then file, then default."""

from __future__ import annotations

from collections.abc import Mapping

_RANGE = {"start_id": 0, "end_id": 0, "limit": 0}
_JOIN = {"min_confidence": 0.0, "llm_merge_gap": 0.8, "llm_merge_max_chars": 28, "llm_merge_max_duration": 4.0, "llm_merge_max_chain": 2, "use_anchor_timing": True, "anchor_min_duration": 0.22, "anchor_smooth_gap": 0.06}
_FRAMES = {"frame_mode": "three", "adaptive_mid_threshold": 1.6, "pad": 0.1, "short_cue_threshold": 0.4, "short_cue_pad": 0.03, "skip_frames": False, "scale_width": 854, "overwrite_frames": False, "yolo_filter": False, "yolo_person_threshold": 0.35, "yolo_conf": 0.5}
_RUN = {"translator": "codex", "workers": 1, "image_policy": "three", "serial_batch_size": 3, "serial_overlap": 1, "serial_history_size": 6, "reasoning_effort": "high", "think_budget": 0, "force": False, "mock": False, "codex_timeout_sec": 240}
#: Defaults of every command.
DEFAULTS = {
    "prepare": _RANGE | _FRAMES,
    "run": _RANGE | _RUN,
    "merge": _JOIN,
    "segment": {"passes": 2, "target_chars": 16, "min_chars": 5, "split_max_chars": 24, "merge_gap": 0.55, "max_merge_duration": 6.5, "split_max_duration": 5.2, "min_part_duration": 0.5, "split_gap": 0.04},
    "refine": _RANGE | {"translator": "codex", "codex_timeout_sec": 180, "save_every": 20, "mock": False},
    "full": _RANGE | _FRAMES | _RUN | _JOIN | {"slug": "", "refine_context_pass": False, "refine_out": "", "refine_timeout_sec": 180, "refine_save_every": 20},
    "dp": {"min_duration": 5 / 6, "max_duration": 7.0, "max_chars": 42, "max_cps": 20.0, "restore_punctuation": True, "block_words": 180, "strict": False},
    "frames": {"ext": "jpg", "person_threshold": 0.7, "conf": 0.5, "preview": False},
}
CHOICES = {"frame_mode": {"three", "mid", "none", "adaptive"}, "image_policy": {"three", "mid", "auto", "none", "rand1"}, "translator": {"codex", "opencode", "ollama", "mock"}}


def options(command: str, file: Mapping | None = None, **given) -> dict:
    """All options of a command. Dashes in names are underscores; unknown names and values are errors; bounds of 0 are none."""
    known, out = DEFAULTS[command], dict(DEFAULTS[command])
    for source in (file or {}, given):
        for name, value in source.items():
            name = str(name).replace("-", "_")
            if name not in known:
                raise KeyError(f"{command} has no option {name}")
            kind = type(known[name])
            if kind is bool and not isinstance(value, bool):
                raise TypeError(f"{name} must be true or false")
            value = kind(value)
            if name in CHOICES and value not in CHOICES[name]:
                raise ValueError(f"{name} must be one of {sorted(CHOICES[name])}")
            out[name] = value
    return out | {k: out[k] or None for k in _RANGE if k in out}


def load(path: str) -> dict:
    """A flat file of ``name: value`` lines with # comments."""
    read = {"true": True, "false": False, "null": None, "": None}
    out = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            line = line.split(" #")[0].strip()
            if line and not line.startswith("#"):
                name, _, value = line.partition(":")
                value = value.strip()
                out[name.strip().replace("-", "_")] = read[value.lower()] if value.lower() in read else value.strip("'\"")
    return out
