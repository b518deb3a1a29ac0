"""Fixed values that results depend on.  They are stated here once, in natural
order, and every operator reads them from this module."""

# --- fixed values: failure classes and their integer codes --------------------
CLASS_NAMES = ["Center", "Donut", "Edge-Loc", "Edge-Ring", "Loc", "Random", "Scratch", "none"]
CLASS_CODES = {"Center": 0, "Donut": 1, "Edge-Loc": 2, "Edge-Ring": 3,
               "Loc": 4, "Random": 5, "Scratch": 6, "none": 7}
EXCLUDED_CLASS = "Near-full"

# --- fixed values: map geometry ---------------------------------------------
TARGET_SIZE = 64          # maps are resized to 64 x 64
MIN_SIDE_EXCLUSIVE = 5    # both sides must be strictly larger than 5
DEFECT = 2                # cell codes: 0 background, 1 pass, 2 defect
PASS = 1

# --- fixed values: 13 density zones on the 64 x 64 map ------------------------
# cuts along each axis are 0, 12, 25, 38, 51, 64; zones 0-3 are full-length
# edge strips (top, right, bottom, left; they overlap in the corners), zones
# 4-12 the inner 3 x 3 blocks in row-major order.  (zone, r0, r1, c0, c1) with
# half-open ranges [r0, r1) x [c0, c1).
ZONE_CUTS = [0, 12, 25, 38, 51, 64]
ZONES = [
    (0, 0, 12, 0, 64),
    (1, 0, 64, 51, 64),
    (2, 51, 64, 0, 64),
    (3, 0, 64, 0, 12),
    (4, 12, 25, 12, 25),
    (5, 12, 25, 25, 38),
    (6, 12, 25, 38, 51),
    (7, 25, 38, 12, 25),
    (8, 25, 38, 25, 38),
    (9, 25, 38, 38, 51),
    (10, 38, 51, 12, 25),
    (11, 38, 51, 25, 38),
    (12, 38, 51, 38, 51),
]

# --- fixed values: Radon projection -------------------------------------------
N_THETA = 72                 # angles 0, 2.5, ..., 177.5 degrees
RADON_POINTS = 20            # profile samples per statistic
RADON_PAD_BEFORE = 13        # 64 -> 91 zero padding (13 before, 14 after)
RADON_SIDE = 91
RADON_CENTER = 45

# --- fixed values: perimeter weights by neighbourhood code -------------------
# code = 1 + 2 * (4-neighbours on the border) + 10 * (diagonal neighbours on
# the border); codes not listed weigh 0.
PERIMETER_WEIGHT_ONE = [5, 7, 15, 17, 25, 27]
PERIMETER_WEIGHT_SQRT2 = [21, 33]
PERIMETER_WEIGHT_HALF = [13, 23]   # weight (1 + sqrt 2) / 2

# --- fixed values: pipeline parameters -----------------------------------------
SEED = 42
TEST_FRACTION = 0.2
TARGET_PER_CLASS = 500
SMOTE_K = 3
N_FOLDS = 3
N_PREFILTER = 1000
N_RFE = 25
N_RF = 25
RFE_STEP = 50
LASSO_C = 0.005
COEF_EPS = 1e-5
RATIO_EPS = 1e-6

# --- fixed values: feature names ---------------------------------------------
DENSITY_NAMES = [f"density_{i}" for i in range(1, 14)]
RADON_MEAN_NAMES = [f"radon_mean_{i}" for i in range(1, 21)]
RADON_STD_NAMES = [f"radon_std_{i}" for i in range(1, 21)]
GEOM_NAMES = ["geom_area", "geom_perimeter", "geom_major_axis", "geom_minor_axis",
              "geom_eccentricity", "geom_solidity", "geom_num_regions"]
STAT_NAMES = ["stat_mean", "stat_std", "stat_var", "stat_skew", "stat_kurt", "stat_median"]
FEATURE_NAMES = DENSITY_NAMES + RADON_MEAN_NAMES + RADON_STD_NAMES + GEOM_NAMES + STAT_NAMES

# --- fixed values: model registry and report tables ---------------------------
MODEL_ORDER = ["SVM", "LogisticReg", "KNN", "GradBoosting", "XGBoost", "RandomForest", "DecisionTree"]
MODEL_DISPLAY = {"LogisticReg": "Logistic Regression", "GradBoosting": "Gradient Boosting"}
GAP_TABLE_MODELS = ["SVM", "LogisticReg", "XGBoost", "GradBoosting"]
TRACK_INFO = [
    ("4B_RFE", "Wrapper (RFE)"),
    ("4D_Lasso", "Embedded (Lasso)"),
    ("4C_RF_Importance", "Embedded (Random Forest)"),
]
OVERFIT_GAP = 0.10
