"""Fixed values and tunable defaults.

The enumerations and defaults below must equal the record contract of the
system being re-implemented; they are stated here once, in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (record contract)
# ---------------------------------------------------------------------------
SEX_VALUES = ("male", "female")
EMBARKED_VALUES = ("s", "c", "q")
TASK_STATUS_SHORT = ("PENDING", "STARTED", "SUCCESS", "FAILURE")
TASK_STATUS_ALL = ("PENDING", "STARTED", "SUCCESS", "FAILURE", "RETRY", "REVOKED")
EMAIL_STATUS = ("dispatched", "failed", "processing", "success")
JOB_STATUS = ("failed", "pending", "processing", "completed")
OUTPUT_STATUS = ("success", "error")
READY_STATES = ("SUCCESS", "FAILURE", "REVOKED")

# Required person fields, and defaults applied when a field is absent.
PERSON_REQUIRED = ("sex", "age", "pclass", "sibsp", "parch", "fare", "embarked")
PERSON_DEFAULTS = {"person_id": None, "survived": 0}

# Status-lookup messages by state.
STATUS_MESSAGES = {
    "PENDING": "Task is waiting to be processed or does not exist",
    "PROGRESS": "Task is currently being processed",
    "SUCCESS": "Task completed successfully",
    "FAILURE": "Task failed",
    "RETRY": "Task is being retried",
    "REVOKED": "Task was revoked",
}

# Column length bounds of the stored tables.
LENGTH_BOUNDS = {"person_id": 50, "sex": 8, "embarked": 8, "recipient": 100,
                 "subject": 100, "status": 50, "job_name": 100}

TEXT_LOG_LIMIT = 1500          # characters kept of result/args/kwargs/error
FILL_AGE = 30.0                # constant used to fill a missing age
THRESHOLD = 0.5                # probability > THRESHOLD -> positive label
API_CHUNK_SIZE = 500
TASK_CHUNK_SIZE = 10
PROGRESS_EVERY = 10            # throttled progress: every 10th item and the last
SAMPLE_ROWS = 20               # rows kept in a job's response sample
RETENTION_DAYS = 30
RESULT_TTL_SECONDS = 3600        # result-backend expiry
HEALTH_WINDOW_HOURS = 24
HEALTH_TASK_PATTERN = "%health_check%"


@dataclass(frozen=True)
class ModelParams:
    """Forest and validation settings (100 trees, depth 10, 5 folds, seed 42)."""

    n_estimators: int = 100
    max_depth: int = 10
    n_splits: int = 5
    seed: int = 42
    test_size: float = 0.2
    max_bins: int = 32
    max_memory_mb: int = 1024     # node-statistics memory per tree-level pass
    parallelism: int = 5          # folds fitted concurrently (like CrossValidator)


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are numeric, categorical and the target."""

    num_vars: tuple[str, ...] = ("age", "fare", "pclass", "sibsp", "parch")
    cat_vars: tuple[str, ...] = ("sex", "embarked")
    target: str = "survived"
    id_col: str = "person_id"
    extra: tuple[str, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [*self.num_vars, *self.cat_vars]
