"""Settings of the stages with range checks, and the fingerprint of a run."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from glosswright.functions.hashing import plain_hash

#: Stages in order.
STAGES = ("download", "transcribe", "normalize", "analyze", "filter", "generate", "train", "evaluate")
#: Editing briefs with their instructions.
BRIEFS = {
    "cleanup_filler": "Remove filler words and verbal clutter while preserving meaning and voice.",
    "tighten_60_percent": "Tighten the text to about 60% of its original length without dropping key facts.",
    "expand_with_examples": "Expand with concrete examples grounded only in the input text.",
    "convert_to_script": "Convert to a concise documentary script style with clear pacing.",
}


def _check(test: bool, message: str) -> None:
    if not test:
        raise ValueError(message)


def _unit(name: str, value: float | None) -> None:
    _check(value is None or 0 <= value <= 1, f"{name} must lie in [0, 1]")


def _ordered(name: str, low: float | None, high: float | None) -> None:
    _check(low is None or high is None or low <= high, f"{name}: the lower bound is over the upper one")


def _from(name: str, value: float | None, least: float, over: bool = False) -> None:
    _check(value is None or (value > least if over else value >= least), f"{name} must be {'over' if over else 'at least'} {least:g}")


#: The names and defaults of all settings below are those of the settings files in use.


@dataclass(frozen=True)
class Download:
    include_shorts: bool = False
    include_live: bool = False
    media: str = "audio"

    def __post_init__(self):
        _check(self.media in ("audio", "video", "none"), "media must be audio, video or none")


@dataclass(frozen=True)
class Transcribe:
    backend: str = "faster_whisper"
    prefer_manual_transcript: bool = True
    allow_auto_generated: bool = False
    language_allowlist: tuple[str, ...] = ("en",)

    def __post_init__(self):
        _check(self.backend in ("faster_whisper", "youtube_native"), "unknown backend")
        _check(bool(self.language_allowlist), "language_allowlist is empty")


@dataclass(frozen=True)
class Normalize:
    enabled: bool = True
    chunk_target_chars: int = 3500
    chunk_hard_max_chars: int = 5500
    chunk_overlap_chars: int = 0

    def __post_init__(self):
        _check(0 < self.chunk_target_chars <= self.chunk_hard_max_chars, "need 0 < chunk_target_chars <= chunk_hard_max_chars")
        _from("chunk_target_chars", self.chunk_target_chars, 200)
        _check(0 <= self.chunk_overlap_chars < self.chunk_target_chars, "chunk_overlap_chars must be under chunk_target_chars")


@dataclass(frozen=True)
class Analyze:
    enabled: bool = True
    minhash_num_perm: int = 128

    def __post_init__(self):
        _check(self.minhash_num_perm > 0, "minhash_num_perm must be positive")


@dataclass(frozen=True)
class Filter:
    enabled: bool = True
    min_words: int = 100
    min_tokens: int = 120
    language_allowlist: tuple[str, ...] = ("en",)
    dedup_threshold: float = 0.85
    min_quality_score: float = 0.2
    normalize_min_token_ratio: float | None = 0.7
    normalize_max_token_ratio: float | None = 1.35
    normalize_min_length_ratio: float | None = 0.7
    normalize_max_length_ratio: float | None = 1.35
    normalize_min_similarity: float | None = 0.65

    def __post_init__(self):
        for name in ("min_words", "min_tokens"):
            _from(name, getattr(self, name), 0)
        for name in ("normalize_min_token_ratio", "normalize_max_token_ratio", "normalize_min_length_ratio", "normalize_max_length_ratio"):
            _from(name, getattr(self, name), 0, over=True)
        _check(bool(self.language_allowlist), "language_allowlist is empty")
        _unit("dedup_threshold", self.dedup_threshold)
        _unit("min_quality_score", self.min_quality_score)
        _unit("normalize_min_similarity", self.normalize_min_similarity)
        _ordered("token ratio", self.normalize_min_token_ratio, self.normalize_max_token_ratio)
        _ordered("length ratio", self.normalize_min_length_ratio, self.normalize_max_length_ratio)


@dataclass(frozen=True)
class Talk:
    turn_pairs: int = 3
    clarifying_question_probability: float = 0.4
    target_tokens_per_assistant_turn: int = 140
    min_source_tokens: int = 120
    max_copy_similarity: float = 0.8
    min_novel_token_ratio: float = 0.18

    def __post_init__(self):
        _check(self.turn_pairs > 0, "turn_pairs must be positive")
        _from("target_tokens_per_assistant_turn", self.target_tokens_per_assistant_turn, 0, over=True)
        _from("min_source_tokens", self.min_source_tokens, 0)
        for name in ("clarifying_question_probability", "max_copy_similarity", "min_novel_token_ratio"):
            _unit(name, getattr(self, name))


@dataclass(frozen=True)
class Edit:
    briefs: tuple[str, ...] = tuple(BRIEFS)
    use_normalized_input: bool = True
    examples_per_chunk: int = 1
    min_source_tokens: int = 120
    cleanup_min_similarity: float = 0.45
    cleanup_max_similarity: float = 0.995
    tighten_target_ratio: float = 0.6
    tighten_ratio_tolerance: float = 0.25
    expand_min_ratio: float = 1.05
    expand_max_ratio: float = 2.6
    max_new_named_entities: int = 10

    def __post_init__(self):
        _check(bool(self.briefs) and set(self.briefs) <= set(BRIEFS), "unknown brief")
        _check(self.examples_per_chunk > 0, "examples_per_chunk must be positive")
        for name in ("min_source_tokens", "tighten_ratio_tolerance", "max_new_named_entities"):
            _from(name, getattr(self, name), 0)
        for name in ("tighten_target_ratio", "expand_min_ratio", "expand_max_ratio"):
            _from(name, getattr(self, name), 0, over=True)
        for name in ("cleanup_min_similarity", "cleanup_max_similarity"):
            _unit(name, getattr(self, name))
        _ordered("cleanup similarity", self.cleanup_min_similarity, self.cleanup_max_similarity)
        _ordered("expand ratio", self.expand_min_ratio, self.expand_max_ratio)

    def generation_settings(self) -> dict[str, Any]:
        """What candidates depend on."""
        return {k: getattr(self, k) for k in ("briefs", "use_normalized_input", "examples_per_chunk", "min_source_tokens")}

    def gate_settings(self) -> dict[str, Any]:
        """What decisions on candidates depend on besides."""
        return {k: v for k, v in dataclasses.asdict(self).items() if k not in self.generation_settings()}


@dataclass(frozen=True)
class Train:
    enabled: bool = True
    seed: int = 3407
    eval_split_ratio: float = 0.1

    def __post_init__(self):
        _check(0 <= self.eval_split_ratio < 1, "eval_split_ratio must lie in [0, 1)")


@dataclass(frozen=True)
class Evaluate:
    enabled: bool = True
    num_generation_samples: int = 3

    def __post_init__(self):
        _from("num_generation_samples", self.num_generation_samples, 0)


@dataclass(frozen=True)
class Pipeline:
    continue_on_error: bool = True
    max_failure_rate: float = 0.2

    def __post_init__(self):
        _unit("max_failure_rate", self.max_failure_rate)


@dataclass(frozen=True)
class Settings:
    download: Download = field(default_factory=Download)
    transcribe: Transcribe = field(default_factory=Transcribe)
    normalize: Normalize = field(default_factory=Normalize)
    analyze: Analyze = field(default_factory=Analyze)
    filter: Filter = field(default_factory=Filter)
    talk: Talk = field(default_factory=Talk)
    edit: Edit = field(default_factory=Edit)
    train: Train = field(default_factory=Train)
    evaluate: Evaluate = field(default_factory=Evaluate)
    pipeline: Pipeline = field(default_factory=Pipeline)

    @classmethod
    def from_dict(cls, values: dict[str, dict[str, Any]]) -> Settings:
        """Strict: unknown sections and fields are errors."""
        parts = {}
        for section, given in values.items():
            known = {f.name: f.default_factory for f in dataclasses.fields(cls)}
            _check(section in known, f"unknown section {section}")
            kind = known[section]
            fields = {f.name for f in dataclasses.fields(kind)}
            _check(set(given) <= fields, f"unknown fields in {section}: {sorted(set(given) - fields)}")
            parts[section] = kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
        return cls(**parts)

    @classmethod
    def load(cls, path: str | Path) -> Settings:
        """From JSON, or from YAML where a YAML library is there."""
        return cls.from_dict(_read(path) or {})

    def fingerprint(self, *files: str | Path) -> str:
        """H5: settings and the bytes of the files they point to."""
        digest = hashlib.sha256(plain_hash(dataclasses.asdict(self)).encode())
        for f in files:
            digest.update(Path(f).read_bytes())
        return digest.hexdigest()

    def enabled(self, stage: str) -> bool:
        """P16."""
        return getattr(getattr(self, stage, None), "enabled", True)


@dataclass(frozen=True)
class PromptTemplate:
    """A named pair of system prompt and user prompt with {names} to fill."""

    name: str
    system_prompt: str
    user_prompt_template: str

    @classmethod
    def load(cls, path: str | Path) -> PromptTemplate:
        """Strict: exactly the three fields, all of them texts; JSON, or YAML where a YAML library is there."""
        values = _read(path)
        fields = {f.name for f in dataclasses.fields(cls)}
        _check(isinstance(values, dict) and set(values) == fields and all(isinstance(v, str) for v in values.values()), f"{path} needs the texts {sorted(fields)} and no other")
        return cls(**values)


def _read(path: str | Path) -> Any:
    text = Path(path).read_text("utf-8")
    if str(path).endswith((".yaml", ".yml")):
        import yaml

        return yaml.safe_load(text)
    return json.loads(text)


def beside(base: str | Path, path: str | Path) -> Path:
    """A path relative to the folder of the settings file."""
    p = Path(path).expanduser()
    return p if p.is_absolute() else (Path(base).parent / p).resolve()
