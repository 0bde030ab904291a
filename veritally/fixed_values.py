"""Patterns, texts, widths and defaults that results depend on.

Everything in this file must keep exactly these values for results to be right;
nothing else in the package hard-codes them.
"""

# --- number patterns -------------------------------------------------------
# Gold solutions: case-sensitive.
GOLD_PATTERN = r"####\s*([-+]?\d+[\d,]*\.?\d*)"

# Completions: ignore-case, tried in this order; the first pattern that hits wins.
COMPLETION_PATTERNS = (
    r"answer is\s*([-+]?\d+[\d,]*\.?\d*)",
    r"####\s*([-+]?\d+[\d,]*\.?\d*)",
    r"=\s*([-+]?\d+[\d,]*\.?\d*)(?:\s|$)",
)

# Letters outside ASCII that equal an ASCII one when case is ignored.
LETTERS_WITHOUT_CASE = {"\u0130": "i", "\u0131": "i", "\u017f": "s", "\u212a": "k"}

# --- prompt ----------------------------------------------------------------
PROMPT_PREFIX = "Question: "
PROMPT_SUFFIX = "\nAnswer: Let's solve this step by step.\n"

# --- scoring ---------------------------------------------------------------
TOLERANCE = 1e-3
GROUP_SIZE = 4
CLIP_EPS = 0.2
PPO_EPOCHS = 3

# --- token shaping and batching -------------------------------------------
MAX_LENGTH = 512
TRAIN_BATCH_SIZE = 2
EVAL_BATCH_SIZE = 32

# --- displayed figures -----------------------------------------------------
DECIMALS = 4
EPOCH_HEADING = ("Epoch ", " Summary:")
LOSS_LABEL = "  Average Loss: "
REWARD_LABEL = "  Average Reward: "
ACCURACY_LABEL = "Test Accuracy: "

# --- comparison report -----------------------------------------------------
REPORT_ROWS = 10
ELLIPSIS_LENGTH = 50
ELLIPSIS = "..."
REPORT_COLUMNS = (
    "Idx",
    "Question (truncated)",
    "GT",
    "Baseline Response (truncated)",
    "Correct?",
    "Trained Response (truncated)",
    "Correct?",
)
REPORT_WIDTHS = (5, 50, 10, 50, 10, 50, 10)
REPORT_SEPARATOR = " | "
REPORT_RULE_WIDTH = 200
MARKDOWN_TITLE = "# Model Comparison on GSM8K Test Questions"
MARKDOWN_RULE = "|-----|----------------------|----|-------------------------------|----------|------------------------------|----------|"
