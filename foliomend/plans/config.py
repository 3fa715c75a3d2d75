"""Settings of a translation."""

from __future__ import annotations

import json
import tomllib
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class TranslateConfig:
    """source_lang and target_lang by name or code; sizes in characters."""

    source_lang: str | None = None
    target_lang: str = "zh"
    max_chunk_chars: int = 4000
    translate_tables: bool = False
    translate_links_text: bool = False
    translate_image_alt: bool = False
    keep_node_markers: bool = True
    strict_placeholder_check: bool = True
    retry_failed_nodes: bool = True
    retry_times: int = 3
    parallel_groups: int = 1
    log_level: str = "INFO"
    translator_type: str = ""

    def with_languages(self, source: str | None, target: str | None) -> TranslateConfig:
        """The settings with other languages, where these are given."""
        return replace(self, source_lang=source or self.source_lang, target_lang=target or self.target_lang)


def default_config() -> TranslateConfig:
    """What is used without a file: English to Chinese by the echo translator, smaller chunks."""
    return TranslateConfig(source_lang="en", max_chunk_chars=3000, translator_type="echo")


def load_config(path: str) -> tuple[TranslateConfig, dict]:
    """(settings, options of the translator) from a JSON, YAML or TOML file; keys that aren't known are ignored."""
    kind, text = Path(path).suffix.lower(), Path(path).read_text(encoding="utf-8")
    if kind == ".json":
        found = json.loads(text)
    elif kind in (".yaml", ".yml"):
        import yaml

        found = yaml.safe_load(text)
    elif kind == ".toml":
        found = tomllib.loads(text)
    else:
        raise ValueError(f"no settings can be read from {kind} files")
    if not isinstance(found, dict):
        raise ValueError("settings must be a mapping")
    known = {f.name for f in fields(TranslateConfig)}
    return replace(default_config(), **{k: v for k, v in found.items() if k in known}), found.get("translator_config", {})
