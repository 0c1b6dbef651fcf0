"""Parameters that define the semantics of the operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ContextConfig:
    target_token: str = "targetdrug"
    other_token: str = "otherdrug"
    fuzzy_threshold: float = 80.0
    window_sizes: tuple[int, ...] = (0, 1, 2)
    natural_window: int = 1
    max_words: int = 250
    long_doc_chars: int = 5000


@dataclass(frozen=True)
class FoldConfig:
    n_folds: int = 5
    seed: int = 42


@dataclass(frozen=True)
class LabelConfig:
    # The label dictionary of the data contract.
    names: dict[int, str] = field(default_factory=lambda: {0: "positive", 1: "negative", 2: "neutral"})
    display_order: tuple[int, ...] = (1, 2, 0)


CONTEXT = ContextConfig()
FOLDS = FoldConfig()
LABELS = LabelConfig()

# A lexicon up to this many names is held as a literal inside the plan; a larger one is joined as a table.
MAX_LITERAL_NAMES = 5000

# Up to this many names are searched for in a text one by one; more are looked up by the keys of the text's runs.
MAX_SCANNED_NAMES = 64
