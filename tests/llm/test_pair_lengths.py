import pytest

from inkmill.llm import pairs

PROMPT = "Describe the old harbour at dawn for a child"
LONG = "I'm sorry, but I can't help with that request. " + " ".join(f"I understand that this is not what you hoped for, and I apologise for answer number {k}." for k in range(8))
STORY = "I'm sorry, but I can't help with that request. The ferry left at dawn. " + " ".join(f"The boats of pier {k} lay still under the lamps and nobody spoke of the storm." for k in range(8))


@pytest.mark.parametrize(
    "response, defect",
    [
        (" ".join([PROMPT] * 8), "copied"),
        (" ".join([PROMPT] * 40), "copied"),
        (LONG, "refusal"),
        ("I'm sorry, but I can't help with that request.\n\nPlease feel free to ask about another topic.\n\nKind regards", "refusal"),
        ("Es tut mir leid, ich kann bei dieser Anfrage nicht helfen.\n\nVielen Dank für Ihr Verständnis.", "refusal"),
        (STORY, None),
        ("I'm sorry, but I can't help with that request.\n\nThe harbour lay grey and calm before the gulls woke.", None),
    ],
)
def test_copies_and_refusals_of_any_length(response, defect):
    prompt = "Beschreibe den Hafen am Morgen für ein Kind." if defect == "refusal" and response.startswith("Es") else PROMPT
    assert pairs.defects([prompt], [response]) == [defect]
