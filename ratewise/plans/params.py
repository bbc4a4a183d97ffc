"""Parameters shared by the registered queries and their SQL checks."""

# Split: a rating is held out when (user*31 + item*17) mod 10 = 0, and every
# rating of a user with user mod 50 = 0 is held out (cold-start users).
SPLIT_TEST_MOD = 10
SPLIT_COLD_MOD = 50

# Exact ALS as checked against closed-form SQL: rank 2, lambda 0.1, seed 0.
EXACT_RANK = 2
EXACT_LAMBDA = 0.1
EXACT_SEED = 0
EXACT_EPOCHS = 2

# Batch and streaming model of the original jobs: rank 5, 7 iterations, 0.1.
WR_RANK = 5
WR_ITER = 7
WR_LAMBDA = 0.1

TOP_N = 10
REPLAY_SLOTS = 4
REFRESH_SLOTS = 3
RECORDS_PER_LINE = 4

# Rounding of floating results in the registered queries (both sides).
FACTOR_DIGITS = 6
RMSE_DIGITS = 8
INIT_DIGITS = 9
