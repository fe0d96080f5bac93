"""Declared constraints of the platforms' tables."""

from __future__ import annotations

from quizlens.operators.constraints import NotNull, Parent, Rule, Unique

# fixed values: keys, unique indexes and references of the provider platform's content tables
PROVIDER: list[Rule] = [
    Unique("course", ("id",)), Unique("course", ("load_id", "ext_id")), Unique("course", ("load_id", "slug")),
    Unique("branch", ("id",)), Unique("branch", ("load_id", "ext_id")), Parent("branch", ("course_id",), "course", ("id",)),
    Unique("module", ("id",)), Parent("module", ("branch_id",), "branch", ("id",)),
    Unique("lesson", ("id",)), Parent("lesson", ("module_id",), "module", ("id",)),
    Unique("item", ("id",)), Parent("item", ("lesson_id",), "lesson", ("id",)), Parent("item", ("type_id",), "item_type", ("id",)),
    Unique("item_type", ("id",)), Unique("assessment_type", ("id",)),
    Unique("assessment", ("id",)), Parent("assessment", ("type_id",), "assessment_type", ("id",)),
    Parent("item_assessment", ("item_id",), "item", ("id",)), Parent("item_assessment", ("assessment_id",), "assessment", ("id",)),
    Unique("question", ("id",)), Unique("question", ("load_id", "ext_id")),
    Parent("assessment_question", ("assessment_id",), "assessment", ("id",)),
    Parent("assessment_question", ("question_id",), "question", ("id",)),
    Parent("q_option", ("question_id",), "question", ("id",)),
]

# what the answer log should hold to; the log's columns name content by external id
PROVIDER_LOG: list[Rule] = [
    NotNull("caq_event", ("question_ext_id",)), NotNull("caq_event", ("user_ext_id",)), Unique("caq_event", ("course_id", "response_ext_id")),
    Parent("caq_event", ("course_id",), "course", ("id",)), Parent("caq_event", ("question_ext_id",), "question", ("ext_id",)),
    Parent("caq_event", ("assessment_ext_id",), "assessment", ("ext_id",)),
    Parent("cqo_event", ("course_id", "response_ext_id"), "caq_event"), Parent("cqo_event", ("option_ext_id",), "q_option", ("ext_id",)),
    Unique("cqo_event", ("course_id", "response_ext_id", "option_ext_id")),
]
