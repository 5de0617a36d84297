"""Fixed values.

These values must equal the ones the original jobs use for results to
match; they are stated here once, in natural order, and imported elsewhere.
"""

# Image file extensions accepted as a download name's suffix,
# compared case-sensitively and without a leading dot (28 entries).
ALLOWED_IMAGE_FORMATS = [
    "bmp", "gif", "jpg", "jpeg", "jp2", "pbm", "pgm", "ppm", "pnm", "png", "tif", "tiff", "exr", "webp",
    "BMP", "GIF", "JPG", "JPEG", "JP2", "PBM", "PGM", "PPM", "PNM", "PNG", "TIF", "TIFF", "EXR", "WEBP",
]

# Fixed value: suffix appended when a download name carries no accepted extension.
DEFAULT_IMAGE_SUFFIX = ".jpg"

# Fixed value: digits of the zero-padded class index in a class directory name.
CLASS_INDEX_DIGITS = 4

# Fixed value: characters cut from the end of a manifest file name (".txt").
MANIFEST_SUFFIX_LENGTH = 4

# Fixed value: files shorter than this many bytes are flagged as too small.
SMALL_FILE_BYTES = 10 * 1024

# Score report layout — header texts and widths, row widths.
REPORT_HEADER_LEFT, REPORT_HEADER_LEFT_WIDTH = "Iterator", 30
REPORT_HEADER_RIGHT, REPORT_HEADER_RIGHT_WIDTH = "Score", 10
REPORT_EPOCH_WIDTH, REPORT_SCORE_WIDTH = 15, 10
REPORT_SEPARATOR = " | "

# Per-channel means of ImageNet-style preprocessing, R, G, B.
IMAGENET_MEANS_RGB = [123.68, 116.779, 103.939]

# Seeds and split share of the data preparation jobs.
SPLIT_SEED = 13
SHUFFLE_SEED = 123
TRAIN_PERCENT = 80

# Training defaults of the distributed training job.
N_CLASSES_DEFAULT = 10
MAX_EPOCHS_DEFAULT = 10
MAX_MINUTES_DEFAULT = 120
BATCH_SIZE_DEFAULT = 128
AVERAGING_FREQUENCY_DEFAULT = 5
PATIENCE_DEFAULT = 3
INIT_SEED_DEFAULT = 12345
L2_DEFAULT = 0.001
LEARNING_RATE_SCHEDULE = {0: 0.01, 500: 0.005, 1000: 0.001}
