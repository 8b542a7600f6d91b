"""Default values of the jobs."""

# Results depend on them, so they are not tuned here.
LOG_PREFIX = "PRODUCT_RATING_PREFIX:"
LOG_TOPIC = "log"
RATING_TOPIC = "recommender"
MICRO_BATCH = "2 seconds"
SIMILARITY_THRESHOLD = 0.4
ITEMCF_LIST_SIZE = 10
USER_LIST_SIZE = 20
CANDIDATE_COUNT = 20
# The recent-rating range 0..20 counts both ends.
RECENT_COUNT = 21
GOOD_SCORE = 3
HASH_BUCKETS = 800
ALS_RANK = 5
ALS_ITERATIONS = 10
ALS_REGULARIZATION = 0.01
GRID_RANKS = (5, 10, 20, 50)
GRID_REGULARIZATIONS = (1.0, 0.1, 0.01)
TRAIN_PERCENT = 80

SEED = 42

# Scores are compared at this many decimals when a list is ordered, so that
# two engines that add in another order still agree; ties go to the smaller id.
SCORE_DIGITS = 9
