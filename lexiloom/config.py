"""Datasets and defaults."""

from __future__ import annotations

from dataclasses import dataclass

SINGLE_LABEL = "single_label_classification"
MULTI_LABEL = "multi_label_classification"

# Defaults of the tokenizer, the loaders and the training runs.
MAX_LENGTH = 512
TOKENIZE_BATCH = 1000
TRAIN_BATCH = 64
EVAL_BATCH = 64
INFERENCE_BATCH = 256
MEGA_BATCHES = 50
MAX_EPOCHS = 10
WEIGHT_DECAY = 0.01
SEED = 123
EARLY_STOP_PATIENCE = 1
EARLY_STOP_THRESHOLD = 0.005
SCORE_DIGITS = 4
DECISION_THRESHOLD = 0.5

# Reserved token ids.
PAD_ID, UNKNOWN_ID, START_ID, END_ID = 0, 1, 2, 3
SPECIAL_TOKENS = {"[PAD]": PAD_ID, "[UNK]": UNKNOWN_ID, "[CLS]": START_ID, "[SEP]": END_ID}

# A table is broadcast, or handed to tasks as one value, only if it was measured below this.
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Dataset:
    """Where a named dataset is stored and what kind of labels it has."""

    name: str
    num_labels: int
    problem_type: str
    database: str = "default"

    @property
    def train(self) -> str:
        return f"{self.database}.{self.name}_train"

    @property
    def test(self) -> str:
        return f"{self.database}.{self.name}_test"

    @property
    def labels(self) -> str:
        return f"{self.database}.{self.name}_labels"

    @property
    def predictions(self) -> str:
        return f"{self.database}.{self.name}_predictions"


# The datasets known by name.
DATASETS = {
    "banking77": Dataset("banking77", 77, SINGLE_LABEL),
    "imdb": Dataset("imdb", 2, SINGLE_LABEL),
    "tweet_emotions": Dataset("tweet_emotions", 11, MULTI_LABEL),
}


def dataset(name: str) -> Dataset:
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}; known: {', '.join(sorted(DATASETS))}")
    return DATASETS[name]
