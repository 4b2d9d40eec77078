"""User messages, message lists and chat text."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import trim_space


def user_message(instruction: Column, input_: Column) -> Column:
    """Instruction, blank line, input; only the instruction where there is no input."""
    return F.when(F.length(input_) > 0, F.concat(instruction, F.lit("\n\n"), input_)).otherwise(
        instruction
    )


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(instruction: Column, input_: Column, output: Column | None = None) -> Column:
    """The chat as an array of {role, content}; without ``output`` only the user turn."""
    turns = [message("user", user_message(instruction, input_))]
    if output is not None:
        turns.append(message("assistant", output))
    return F.array(*turns)


@dataclass(frozen=True)
class ChatTemplate:
    """How a model family writes a chat down."""

    bos: str
    turns: dict[str, tuple[str, str]]
    generation_prompt: str = ""
    trimmed: tuple[str, ...] = ("user", "assistant")


# The publicly documented chat formats of the two model families.
TEMPLATES = {
    "mistral": ChatTemplate(
        bos="<s>",
        turns={"user": ("[INST] ", "[/INST]"), "assistant": (" ", "</s>")},
        trimmed=("assistant",),
    ),
    "llama3": ChatTemplate(
        bos="<|begin_of_text|>",
        turns={
            "user": ("<|start_header_id|>user<|end_header_id|>\n\n", "<|eot_id|>"),
            "assistant": ("<|start_header_id|>assistant<|end_header_id|>\n\n", "<|eot_id|>"),
        },
        generation_prompt="<|start_header_id|>assistant<|end_header_id|>\n\n",
    ),
}


def render(
    chat: Column, template: str = "mistral", add_generation_prompt: bool = False
) -> Column:
    """Render a message array, beginning-of-sequence mark included."""
    spec = TEMPLATES[template]

    def turn(m: Column) -> Column:
        text = F.lit(None).cast("string")
        for role, (before, after) in spec.turns.items():
            content = trim_space(m["content"]) if role in spec.trimmed else m["content"]
            text = F.when(
                m["role"] == role, F.concat(F.lit(before), content, F.lit(after))
            ).otherwise(text)
        return text

    tail = spec.generation_prompt if add_generation_prompt else ""
    return F.concat(F.lit(spec.bos), F.array_join(F.transform(chat, turn), ""), F.lit(tail))


def drop_bos(text: Column, template: str = "mistral") -> Column:
    """Remove one leading mark: the tokenizer that reads this text adds its own."""
    bos = TEMPLATES[template].bos
    return F.when(F.startswith(text, F.lit(bos)), F.substring(text, len(bos) + 1, 2**31 - 1)).otherwise(text)


def training_text(chat: Column, template: str = "mistral") -> Column:
    return drop_bos(render(chat, template), template)


def generation_prompt(instruction: Column, input_: Column, template: str = "mistral") -> Column:
    """The user turn ready for generation. The mark stays: nothing adds it later."""
    return render(messages(instruction, input_), template, add_generation_prompt=True)
