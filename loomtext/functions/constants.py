"""Values that must stay exactly as they are for results to agree.

Everything here is a fixed value: word lists, message texts, prompt wordings,
formats and default thresholds.
"""

# --- Fixed values: English stop words, in the order in which the list is published. ---
ENGLISH_STOPWORDS: tuple[str, ...] = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them
    their theirs themselves what which who whom this that that'll these those am is are was
    were be been being have has had having do does did doing a an the and but if or because
    as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there
    when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don don't should should've now d ll m o re ve y
    ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
    haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
    shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# --- Fixed values: question words ignored when sentences are matched against a query. ---
QUESTION_WORDS: tuple[str, ...] = (
    "what", "when", "where", "how", "can", "is", "are", "do",
    "the", "a", "an", "on", "in", "to", "for",
)

# --- Fixed values: fused words that the word tokeniser cuts in two (head, tail). ---
FUSED_WORDS: tuple[tuple[str, str], ...] = (
    ("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"),
)

# --- Fixed values: chunk splitting preference and default sizes. ---
CHUNK_SEPARATORS: tuple[str, ...] = ("\n\n", "\n", ". ", " ", "")
CHUNK_SIZE = 400
CHUNK_OVERLAP = 80
CHUNK_ID_FORMAT = "CHUNK-%02d"
FAQ_ID_FORMAT = "faq_%03d"

# --- Fixed values: thresholds and depths. ---
SEARCH_TOP_K = 3
SEARCH_THRESHOLD = 0.10
FALLBACK_THRESHOLD = 0.20
OOD_THRESHOLD = 0.50
GUARDRAIL_THRESHOLD = 0.25
STRONG_MATCH = 0.65
AMBIGUOUS_MATCH = 0.35

# --- Fixed values: statuses and message texts. ---
STATUS_SUCCESS = "SUCCESS"
STATUS_FALLBACK = "FALLBACK_TRIGGERED"
STATUS_CONFIRMED = "CONFIRMED_INTENT"
STATUS_OOD = "OOD_FALLBACK_TRIGGERED"
STATUS_REFUSAL = "GUARDRAIL_REFUSAL"
STATUS_API_ERROR = "API_ERROR"
STATUS_CONNECTION_ERROR = "CONNECTION_ERROR"
NO_NOTE = "No diagnostic note available for this scenario."
VERDICT_STRONG = "Strong Semantic Match"
VERDICT_AMBIGUOUS = "Ambiguous / Weak"
VERDICT_UNRELATED = "Unrelated Meaning"
REFUSAL_SENTINEL = (
    "I CANNOT FIND THIS IN THE CAMPUS DOCUMENTS. "
    "Please contact the Dean of Students Office for guidance."
)
FALLBACK_MESSAGE = (
    "I'm sorry, I could not find a verified campus policy matching your exact wording. "
    "Please contact the Student Services Central Desk at help@campus.edu."
)
FALLBACK_ACTIONS: tuple[str, ...] = (
    "Try rephrasing your question using official administrative terms.",
    "Check the campus directory at directory.campus.edu.",
)
OOD_MESSAGE = "This question appears to be outside the known campus support categories."

# --- Fixed values: the two prompt wordings, as (text before the context, text between the
# context and the question, text after the question). ---
PROMPT_SHORT: tuple[str, str, str] = (
    "You are the official Campus Support AI Assistant.\n"
    "Answer ONLY using the provided policy context. "
    "Cite the source chunk ID for every policy claim.\n"
    f"If the context does not support an answer, respond with exactly: {REFUSAL_SENTINEL}\n"
    "\n"
    "CONTEXT:\n",
    "\n\nSTUDENT QUESTION:\n",
    "\n\nANSWER:",
)
PROMPT_LONG: tuple[str, str, str] = (
    "You are the official AI Campus Policy Assistant.\n"
    "Your task is to answer the student's question accurately, concisely, and STRICTLY based on "
    "the retrieved context chunks below.\n"
    "\n"
    "### RETRIEVED CONTEXT CHUNKS:\n",
    "\n\n### OPERATIONAL RULES:\n"
    "1. Base your answer ONLY on the retrieved context above. "
    "Do NOT use outside general knowledge or assumptions.\n"
    "2. If the retrieved context does not contain enough information to answer the question "
    "truthfully, reply EXACTLY with:\n"
    f'   "{REFUSAL_SENTINEL}"\n'
    "3. Cite the source chunk IDs (e.g., [CHUNK-02]) for each policy fact you mention.\n"
    "\n"
    "Student Question: ",
    "\nHelpful & Cited Answer:",
)
PROMPTS = {"short": PROMPT_SHORT, "long": PROMPT_LONG}
