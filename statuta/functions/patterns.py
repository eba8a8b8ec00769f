"""Patterns that both column expressions and batch functions use."""

#: Patterns of references in text.
SECTION = r"([sS]ection\W*[0-9]+(?=)|[sS]ections\W*[0-9]+(?=)|\b[sS]+\W*[0-9]+(?=))(\W*\([0-9]+\))?"
OBLIQUE = r"(the|this|that|The|This|That)\s(Act)"
NUMBERED = r"(the|this|that|The|This|That)\s([0-9]{4})\s(Act)"
LEGISLATION_REF = r'<ref(((?!ref>).)*)type="legislation"(.*?)ref>'
