import pytest

from inkmill.llm import pairs

ASK = "Write a short story about the river at night."
ZH = "夜里的河水静静地流过村庄，老船夫点起了灯，等待最后一位客人。"
EL = "Το ποτάμι κυλούσε ήσυχα τη νύχτα και ο γέρος άναψε το φανάρι του."
RU = "Ночью река тихо текла мимо деревни, и старый лодочник зажёг фонарь."
KO = "밤의 강은 마을 옆을 조용히 흘렀고 늙은 뱃사공은 등불을 켰다."


@pytest.mark.parametrize(
    "prompt, response, defect",
    [
        *[(ASK, r, "wrong_language") for r in (ZH, EL, RU, KO)],
        (ASK, f"Sure, here it is: {ZH}", "wrong_language"),
        (ZH, "The river ran quietly past the village and the ferryman lit his lamp.", "wrong_language"),
        (f"{ASK} Please answer in Chinese.", ZH, None),
        ("Erzähle auf Russisch vom Fluss bei Nacht.", RU, None),
        (ASK, "The ferryman read the sign, 夜, and lit his lamp before the river rose.", None),
        (ASK, "Let α and β be the banks of the river; the ferryman rowed from α to β.", None),
        (ZH, ZH[:20] + "。", None),
    ],
)
def test_other_scripts_are_other_languages(prompt, response, defect):
    found = pairs.defects([prompt], [response])
    assert found == [defect] or defect is None and found[0] != "wrong_language"
