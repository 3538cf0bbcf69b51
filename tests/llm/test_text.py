from tallywick.llm.text import decoded, folded, stream, streams


def test_what_a_reader_sees():
    assert folded("Zep-\nhan <b>A​G</b>REE&#32;th\xadat") == "zephan agree that"
    assert folded("ha̧lvie cаrdѕ ﬁne ｆｕｌｌ") == "halvie cards fine full"
    assert decoded("one<br>two<i>three</i>") == "one twothree"
    assert decoded('{"text": "N\\u00e3o\\n2"}') == '{"text": "Não\n2"}'
    assert decoded("Tuesdayâ€¦ cafÃ©") == "Tuesday… café"
    assert decoded("") == "" and folded("​﻿") == ""


def test_every_escape_is_undone_however_few_and_deep():
    assert decoded("one%20two three=C3=A9 4") == "one two threeé 4" and decoded("100% sure, a = b, x=zz") == "100% sure, a = b, x=zz"
    assert decoded("a%25252520b &amp;amp;amp;lt; c=3D3D20d") == "a b < c d"
    assert decoded("%" + "25" * 100_000 + "20") == " " and decoded("&" + "amp;" * 100_000) == "&"
    assert streams("five%20 of them") == [stream("five of them"), stream("five 20 of them")] and len(streams("plain")) == 1


def test_stream_marks_what_stands_between():
    assert stream("ab, c-d") == ("abcd", "1011")
    assert stream("…") == ("", "")
