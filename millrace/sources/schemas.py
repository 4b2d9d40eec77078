"""Row shapes of the stages, as Spark DDL."""

RAW_LEGAL = "row_id bigint, domain string, source string, text string, summary string"
RAW_MEDICAL = "row_id bigint, domain string, source string, question string, answer string"
RAW_SUPPORT = "row_id bigint, domain string, source string, ticket string, resolution string"
RAW_MIXED = (
    "row_id bigint, domain string, source string, text string, summary string, "
    "question string, answer string, ticket string, resolution string"
)
EXAMPLE = "row_id bigint, domain string, instruction string, input string, output string"
RESULT = (
    "row_id bigint, domain string, instruction string, prompt_text string, reference string, "
    "base_output string, finetuned_output string"
)
USAGE = (
    "timestamp double, domain string, query string, response string, latency_ms int, "
    "feedback string"
)
CHAT_REQUEST = (
    "row_id bigint, domain string, message string, max_tokens int, temperature double"
)
VOTE = "row_id bigint, choice string"
JUDGE_REPLIES = "row_id bigint, base_reply string, finetuned_reply string"
REPLY = "row_id bigint, domain string, reply string"
LOSS = "n bigint, base_loss double, finetuned_loss double"
