"""Constants shared by every operator.

Fixed values: these must equal the modelled pipeline's for right results.

- A telemetry line has 26 fields, in this order:
  unit, cycle, op_setting_1, op_setting_2, op_setting_3, sensor_1 ... sensor_21
- Kept sensors (14): sensor_2, sensor_3, sensor_4, sensor_7, sensor_8, sensor_9, sensor_11,
  sensor_12, sensor_13, sensor_14, sensor_15, sensor_17, sensor_20, sensor_21
- Flat sensors (7): sensor_1, sensor_5, sensor_6, sensor_10, sensor_16, sensor_18, sensor_19
- Rolling window: 5 rows, the current one included
- Feature order: the 14 kept sensors, then their 14 rolling means, then their 14 rolling stds
- Failure horizon: RUL <= 30; default class cutoff 0.5; recall-biased cutoff 0.3
- Sequence length: 30 rows, stride 1, target taken at the window's last row
- Validation share 0.2 of units, early-stop share 0.15 of training units, seed 42
- Boosted trees: 100 rounds, depth 5, step 0.1, seed 42
- Bootstrap: 10000 resamples, seed 42, percentiles 2.5 and 97.5
- A scoring request carries 1 to 5 readings of all 21 sensors, oldest first
"""

from __future__ import annotations

OP_SETTINGS = ["op_setting_1", "op_setting_2", "op_setting_3"]
ALL_SENSORS = [f"sensor_{i}" for i in range(1, 22)]
TELEMETRY_COLUMNS = ["unit", "cycle", *OP_SETTINGS, *ALL_SENSORS]

KEPT_SENSORS = [
    "sensor_2", "sensor_3", "sensor_4", "sensor_7", "sensor_8", "sensor_9", "sensor_11",
    "sensor_12", "sensor_13", "sensor_14", "sensor_15", "sensor_17", "sensor_20", "sensor_21",
]
FLAT_SENSORS = ["sensor_1", "sensor_5", "sensor_6", "sensor_10", "sensor_16", "sensor_18", "sensor_19"]

ROLLING_WINDOW = 5
FAILURE_HORIZON = 30
DEFAULT_CUTOFF = 0.5
RECALL_CUTOFF = 0.3
SEQUENCE_LENGTH = 30

VALIDATION_SHARE = 0.2
EARLY_STOP_SHARE = 0.15
SEED = 42

TREE_ROUNDS = 100
TREE_DEPTH = 5
TREE_STEP = 0.1
# Rounds without a better held-out error before boosting stops.
PATIENCE = 10

BOOTSTRAP_RESAMPLES = 10000
CI_PERCENTILES = (0.025, 0.975)

REQUEST_MIN_READINGS = 1
REQUEST_MAX_READINGS = 5

# Our own choices (not taken from the modelled pipeline).
# Rows per chunk when a unit's history is split for skew-safe windows.
CHUNK_ROWS = 100_000
# A fitted scale at or below this share of |mean| counts as zero variance.
FLAT_TOLERANCE = 1e-12
