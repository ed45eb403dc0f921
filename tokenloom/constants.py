"""Fixed values and defaults.

The values in the first block must stay exactly as they are: they are the
in-band sentinels and the marker that the produced token tables are defined
by.  Everything below them is a tunable default.
"""

# --- fixed values (must equal the data model's sentinels) -----------------
EOS_ID = 50256          # end-of-sample / padding id
IGNORE_LABEL = -100     # label value that the loss ignores
UNKNOWN_ID = -1         # id of a token that the vocabulary does not hold
MASKED_ATTENTION = 0    # attention value of padding and of the appended EOS
MARKER = "<DFF>"        # the model completes the text after this marker
ARCHIVE_SUFFIX = "jsonl.zst"   # archive file glob is "*jsonl.zst" (no dot)

# --- tokenizer ---------------------------------------------------------------
# One token = a run of word characters, or any single character that is not a
# word character and not blank.  Explicit classes (not \w, \s) so that Java
# regex and RE2 agree.
TOKEN_PATTERN = r"([A-Za-z0-9_]+|[^A-Za-z0-9_ \t\r\n])"

# --- defaults ----------------------------------------------------------------
DEFAULT_MAX_TOKENS = 2048
DEFAULT_BLOCK_SIZE = 2048
DEFAULT_BATCH_ROWS = 1000
DEFAULT_CHUNK_SIZE = 500_000
DEFAULT_VALIDATION_PERCENT = 5

# rows per range bucket used by the two-level dense index
DEFAULT_BUCKET_ROWS = 1 << 16
# most frequent tokens that every task holds for encoding (at most 65 bytes
# each); the others are joined
VOCAB_HEAD_ROWS = 1 << 19
# largest number of row indexes per line of a text index file
INDEX_TEXT_CHUNK = 1_000_000
