"""Settings of a run, read from YAML, and the prompt templates."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

import yaml

DEFAULT_COUNT = 3
#: Records asked for per chunk; fixed values.
COUNTS = {"qa_pairs_per_chunk": 5, "conversations_per_chunk": 2, "completions_per_chunk": 3, "classifications_per_chunk": 3}
#: Generation type -> system prompt, instruction, count key, output folder; fixed values.
TYPES = {
    "qa": ("qa_system", "qa_instruction", "qa_pairs_per_chunk", "qa"),
    "conversation": ("conversation_system", "conversation_instruction", "conversations_per_chunk", "conversations"),
    "completion": ("completion_system", "completion_instruction", "completions_per_chunk", "completions"),
    "classification": ("classification_system", "classification_instruction", "classifications_per_chunk", "classification"),
}
#: Instructions for tabular chunks; other types have none of their own. Fixed values.
TABULAR = {"qa": "training_log_qa_instruction", "conversation": "training_log_conversation_instruction"}
PROMPTS = {
    "qa_system": "Write question and answer pairs that teach what a source text says.",
    "qa_instruction": 'Write {n} question and answer pairs about the text below, each as JSON {{"instruction": "...", "response": "..."}}.\n\n{text}',
    "conversation_system": "Write conversations between a coach and a client that rest on a source text.",
    "conversation_instruction": 'Write {n} conversations about the text below, each as JSON {{"messages": [{{"role": "user", "content": "..."}}, {{"role": "assistant", "content": "..."}}]}}.\n\n{text}',
    "completion_system": "Write openings and continuations that explain what a source text says.",
    "completion_instruction": 'Write {n} openings with their continuation from the text below, each as JSON {{"prompt": "...", "completion": "..."}}.\n\n{text}',
    "classification_system": "Write short passages with a topic label.",
    "classification_instruction": 'Write {n} passages from the text below, each with one label of: {topics}. Use JSON {{"text": "...", "label": "..."}}.\n\n{text}',
    "training_log_qa_instruction": 'Write {n} question and answer pairs about the training log below, each as JSON {{"instruction": "...", "response": "..."}}.\n\n{text}',
    "training_log_conversation_instruction": 'Write {n} conversations in which a coach and an athlete review the log below, each as JSON {{"messages": [{{"role": "user", "content": "..."}}, {{"role": "assistant", "content": "..."}}]}}.\n\n{text}',
}


@dataclass
class Settings:
    model: str = ""
    max_tokens: int = 2048
    temperature: float = 0.7
    counts: dict[str, int] = field(default_factory=lambda: dict(COUNTS))
    topics: list[str] = field(default_factory=list)
    prompts: dict[str, str] = field(default_factory=lambda: dict(PROMPTS))
    split: tuple[float, float] = (0.8, 0.1)

    @classmethod
    def load(cls, path: str) -> Settings:
        data = (yaml.safe_load(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else None) or {}
        llm = data.get("llm") or {}
        split = (data.get("data") or {}).get("train_val_test_split") or (0.8, 0.1)
        if len(split) < 2 or min(split) < 0 or sum(split) > 1 + 1e-9:
            raise ValueError(f"split ratios must be two or three shares of one: {split}")
        return cls(
            llm.get("model", ""), llm.get("max_tokens", 2048), llm.get("temperature", 0.7),
            dict(data.get("generation") or COUNTS), list(data.get("topics") or []), dict(data.get("prompts") or PROMPTS), (float(split[0]), float(split[1])),
        )

    def prompt(self, name: str) -> str:
        return self.prompts.get(name, "")

    def count(self, name: str) -> int:
        return self.counts.get(name, DEFAULT_COUNT)

    @staticmethod
    def api_key(variable: str) -> str:
        """The key in an environment variable; checked on the driver before a job starts."""
        value = os.environ.get(variable)
        if not value:
            raise ValueError(f"{variable} is not set")
        return value
