"""Fixed values.

Every string below is part of an output format or of a detection rule, so it
must stay exactly as it is for results to be right. Nothing here is logic.
"""

# --- Column names looked for, in order of priority -------------------------
TEXT_COLUMNS = ("text", "content", "full_text")
CHAT_COLUMNS = ("conversations", "messages", "chat")
INSTRUCTION_COLUMNS = ("instruction", "prompt", "question", "input_text")
OUTPUT_COLUMNS = ("output", "response", "answer", "completion")
INPUT_COLUMNS = ("input", "context", "background")

# --- Instruction format ----------------------------------------------------
INSTRUCTION_HEADING = "### Instruction:\n"
INPUT_HEADING = "### Input:\n"
RESPONSE_HEADING = "### Response:\n"
BLOCK_GAP = "\n\n"

# --- Movie format ----------------------------------------------------------
MOVIE_TEMPLATE = """### Instruction:
Generate a persuasive movie recommendation for a user. Highlight why they should watch the movie using its genre, themes, storyline, and popularity.

### Movie Metadata:
Title: {title}
Tagline: {tagline}
Overview: {overview}
Genres: {genres}
Keywords: {keywords}
Vote Average: {vote_average}
Vote Count: {vote_count}
Popularity: {popularity}
Release Date: {release_date}
Runtime: {runtime} minutes

### Response:
Here’s why you might enjoy this movie:
"""
NO_OVERVIEW = "No overview available."
NO_TAGLINE = ""
NAME_SEPARATOR = ", "

# --- ChatML marks ----------------------------------------------------------
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"

# --- ShareGPT speaker names ------------------------------------------------
SHAREGPT_ROLES = {"human": "user", "gpt": "assistant"}

# --- Training log ----------------------------------------------------------
LOG_STEP = "Step "
LOG_LOSS = ": Loss "
LOG_LOSS_COLON = ": Loss: "
NO_LOSS = "N/A"

# --- Status texts ----------------------------------------------------------
LOAD_ERROR = "Data loading error: "
PREVIEW_OK = "Dataset Loaded Successfully"
PREVIEW_ERROR = "Error: "

# --- Labels ----------------------------------------------------------------
IGNORED_LABEL = -100

# --- Python names of values ------------------------------------------------
PY_NONE = "None"
PY_TRUE = "True"
PY_FALSE = "False"
