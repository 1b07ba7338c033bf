"""Fixed values.

Everything here has to equal a published format exactly, otherwise results differ:
special tokens and their ids, the byte-level pre-token pattern, prompt templates,
answer labels and the loss mask.
"""

# --- fixed values: special tokens, ids are their positions -----------------------
UNK_TOKEN = "<unk>"
BOS_TOKEN = "<bos>"
EOS_TOKEN = "<eos>"
PAD_TOKEN = "<pad>"
SPECIAL_TOKENS = (UNK_TOKEN, BOS_TOKEN, EOS_TOKEN, PAD_TOKEN)
UNK_ID, BOS_ID, EOS_ID, PAD_ID = 0, 1, 2, 3

# --- fixed values: byte-level pre-tokens (the published GPT-2 pattern) ------------
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# --- fixed values: byte ranges in the order their printable forms sort ------------
BYTE_RANGES = ((33, 126), (161, 172), (174, 255), (0, 32), (127, 160), (173, 173))
BYTE_VOCAB_SIZE = len(SPECIAL_TOKENS) + 256

# --- fixed values: instruction prompt templates (published Alpaca wording) --------
PROMPT_WITH_INPUT = (
    "Below is an instruction that describes a task, paired with an input that "
    "provides further context. Write a response that appropriately completes "
    "the request.\n\n### Instruction:\n{instruction}\n\n### Input:\n{input}"
    "\n\n### Response:\n"
)
PROMPT_WITHOUT_INPUT = (
    "Below is an instruction that describes a task. Write a response that "
    "appropriately completes the request.\n\n### Instruction:\n{instruction}"
    "\n\n### Response:\n"
)
IGNORE_INDEX = -100

# --- fixed values: multiple-choice prompt wording ----------------------------------
CHOICE_LABELS = ("A", "B", "C", "D")
CHOICE_HEADER = "The following are multiple choice questions (with answers) about "

# --- fixed values: token table -----------------------------------------------------
CACHE_VERSION = 1
UINT16_VOCAB = 2**16
INT32_VOCAB = 2**31

# --- fixed values: reports ---------------------------------------------------------
WILSON_Z = 1.959964
CHANCE = 0.25

# --- Markdown sample report --------------------------------------------------------
REPORT_TITLE = "# Samples of generated text"
REPORT_SETTINGS = (
    "Checkpoint",
    "Training stage",
    "Mode",
    "Temperature",
    "Top-k",
    "Maximum new tokens",
)
REPORT_NOTE = (
    "Read these as single draws under the settings above. They measure nothing; "
    "quote the settings with them."
)
