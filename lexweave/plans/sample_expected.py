"""What the queries over the sample contract must give: (columns with their types, rows).

The rows were taken from the operators once and read through against the contract; they hold results fixed.
"""

from __future__ import annotations

REFERENCES = (
    [('path', 'VARCHAR'), ('text', 'VARCHAR'), ('ref_kind', 'VARCHAR'), ('status', 'VARCHAR'), ('scope_rule', 'VARCHAR'), ('target_path', 'VARCHAR'), ('resolver', 'VARCHAR')],
    [
        ('call-off-schedule-9/a/3/3.4/ref@14-17', '3.4', 'paragraph', 'resolved', 'js1_1.3.9', 'call-off-schedule-9/a/3/3.4', 'scope'),
        ('call-off-schedule-9/a/3/3.4/ref@28-29', '1', 'annex', 'resolved', 'js1_1.3.8', 'call-off-schedule-9/b/annex-1', 'scope'),
        ('call-off-schedule-9/b/2/ref@3-16', 'this Schedule', 'schedule', 'ambiguous', 'none', None, 'scope'),
        ('call-off-schedule-9/b/3/3.4/ref@37-40', '3.4', 'paragraph', 'resolved', 'js1_1.3.9', 'call-off-schedule-9/b/3/3.4', 'scope'),
        ('call-off-schedule-9/b/3/3.4/ref@52-55', '1.2', 'clause', 'resolved', 'js1_1.3.8', 'core-terms/1/1.2', 'scope'),
        ('core-terms/1/1.1/a/ref@42-57', '1 (Definitions)', 'schedule', 'resolved', 'title_paren', 'joint-schedule-1', 'scope'),
        ('core-terms/1/1.1/a/ref@69-75', '2.1(a)', 'clause', 'resolved', 'js1_1.3.8', 'core-terms/2/2.1/a', 'scope'),
        ('core-terms/1/1.1/b/ref@25-27', '55', 'legislation', 'external', 'none', 'legislation/patents-act-1977/section/55', 'grammar'),
        ('core-terms/1/1.1/b/ref@56-80', 'Regulation (EU) 2016/679', 'legislation', 'external', 'none', 'legislation/regulation-eu-2016-679', 'grammar'),
        ('core-terms/1/1.1/intro/ref@38-41', '2.1', 'clause', 'resolved', 'js1_1.3.8', 'core-terms/2/2.1', 'scope'),
        ('core-terms/1/1.1/intro/ref@38-48', '2.1 to 2.3', 'clause', 'unresolved', 'js1_1.3.8', None, 'scope'),
        ('core-terms/1/1.1/intro/ref@45-48', '2.3', 'clause', 'resolved', 'js1_1.3.8', 'core-terms/2/2.3', 'scope'),
        ('core-terms/1/1.1/intro/ref@62-63', '6', 'schedule', 'ambiguous', 'none', None, 'scope'),
        ('core-terms/1/1.2/ref@0-11', 'This Clause', 'clause', 'ambiguous', 'none', None, 'scope'),
        ('core-terms/1/1.2/ref@16-29', 'that Schedule', 'schedule', 'ambiguous', 'none', None, 'scope'),
        ('core-terms/1/1.2/ref@64-67', '3.4', 'paragraph', 'resolved', 'js1_1.3.9', 'call-off-schedule-9/a/3/3.4', 'scope'),
        ('core-terms/1/1.2/ref@89-90', '9', 'schedule', 'resolved', 'js1_1.3.8', 'call-off-schedule-9', 'scope'),
        ('core-terms/2/2.1/b/ref@41-44', '9.9', 'clause', 'unresolved', 'js1_1.3.8', None, 'scope'),
        ('core-terms/2/2.3/ref@56-57', '4', 'schedule', 'unresolved', 'js1_1.3.8', None, 'scope'),
        ('joint-schedule-1/table-0/1/1/ref@34-35', '4', 'schedule', 'ambiguous', 'none', None, 'scope'),
    ],
)

ORPHANS = (
    [('parent_path', 'VARCHAR'), ('keyword', 'VARCHAR'), ('start', 'INTEGER'), ('end', 'INTEGER'), ('verdict', 'VARCHAR'), ('sentence', 'VARCHAR')],
    [
        ('call-off-schedule-9/b/3/3.4', 'act', 101, 104, 'generic_prose', 'Supplier staff must act.'),
        ('core-terms/2/2.1/b', 'schedule', 3, 11, 'generic_prose', 'No schedule of rates applies;'),
        ('joint-schedule-1/table-0/3/1', 'part', 8, 12, 'generic_prose', 'means a part that the Supplier makes;'),
    ],
)

TERM_USES = (
    [('term', 'VARCHAR'), ('path', 'VARCHAR'), ('field', 'VARCHAR'), ('surface', 'VARCHAR'), ('status', 'VARCHAR'), ('ambiguity_kind', 'VARCHAR')],
    [
        ('Breach', 'call-off-schedule-9/b/3/3.4', 'text', 'Breach', 'confident', None),
        ('Charges', 'core-terms/2/2.1/a', 'text', 'Charges', 'confident', None),
        ('Charges', 'core-terms/2/2.3', 'text', 'Charges', 'confident', None),
        ('Key Performance Indicator', 'call-off-schedule-9/b/3/3.4', 'text', 'KPIs', 'ambiguous', 'sentence_initial'),
        ('Supplier', 'call-off-schedule-9/b/2', 'text', 'Supplier', 'confident', None),
        ('Supplier', 'call-off-schedule-9/b/3/3.4', 'text', 'Supplier', 'ambiguous', 'sentence_initial'),
        ('Supplier', 'core-terms/1/1.1/intro', 'text', 'Supplier', 'confident', None),
        ('Supplier', 'core-terms/1/1.2', 'text', 'Supplier', 'confident', None),
        ('Supplier', 'joint-schedule-1/table-0/2/1', 'text', 'Supplier', 'confident', None),
        ('Supplier', 'joint-schedule-1/table-0/3/1', 'text', 'Supplier', 'confident', None),
        ('Widget', 'call-off-schedule-9/b/3/3.4', 'text', 'Widgets', 'confident', None),
        ('Widget', 'core-terms/1/1.1/a', 'text', 'Widget', 'confident', None),
    ],
)

NAMES = (
    [('path', 'VARCHAR'), ('name', 'VARCHAR')],
    [
        ('call-off-schedule-9', 'Call-Off Schedule 9 (Security)'),
        ('call-off-schedule-9/a', 'Call-Off Schedule 9 (Security)'),
        ('call-off-schedule-9/a/3', 'Call-Off Schedule 9 (Security), Paragraph 3'),
        ('call-off-schedule-9/a/3/3.4', 'Call-Off Schedule 9 (Security), Paragraph 3.4'),
        ('call-off-schedule-9/b', 'Call-Off Schedule 9 (Security)'),
        ('call-off-schedule-9/b/2', 'Call-Off Schedule 9 (Security), Paragraph 2'),
        ('call-off-schedule-9/b/3', 'Call-Off Schedule 9 (Security), Paragraph 3'),
        ('call-off-schedule-9/b/3/3.4', 'Call-Off Schedule 9 (Security), Paragraph 3.4'),
        ('call-off-schedule-9/b/annex-1', 'Call-Off Schedule 9 (Security)'),
        ('core-terms', 'Core Terms'),
        ('core-terms/1', 'Core Terms, 1.'),
        ('core-terms/1/1.1', 'Core Terms, Clause 1.1'),
        ('core-terms/1/1.1/a', 'Core Terms, Clause 1.1(a)'),
        ('core-terms/1/1.1/b', 'Core Terms, Clause 1.1(b)'),
        ('core-terms/1/1.1/intro', 'Core Terms, Clause 1.1'),
        ('core-terms/1/1.2', 'Core Terms, Clause 1.2'),
        ('core-terms/2', 'Core Terms, 2.'),
        ('core-terms/2/2.1', 'Core Terms, Clause 2.1'),
        ('core-terms/2/2.1/a', 'Core Terms, Clause 2.1(a)'),
        ('core-terms/2/2.1/b', 'Core Terms, Clause 2.1(b)'),
        ('core-terms/2/2.3', 'Core Terms, Clause 2.3'),
        ('core-terms/3', 'Core Terms, 3.'),
        ('core-terms/preamble', 'Core Terms'),
        ('form-1', 'Order Form'),
        ('form-1/1', 'Order Form, 1'),
        ('form-1/2', 'Order Form, 2'),
        ('joint-schedule-1', 'Joint Schedule 1 (Definitions)'),
        ('joint-schedule-1/1', 'Joint Schedule 1 (Definitions), Paragraph 1'),
        ('joint-schedule-1/table-0', 'Joint Schedule 1 (Definitions)'),
        ('joint-schedule-1/table-0/0/0', 'Joint Schedule 1 (Definitions)'),
        ('joint-schedule-1/table-0/0/1', 'Joint Schedule 1 (Definitions)'),
        ('joint-schedule-1/table-0/1/0', 'Joint Schedule 1 (Definitions)'),
        ('joint-schedule-1/table-0/1/1', 'Joint Schedule 1 (Definitions)'),
        ('joint-schedule-1/table-0/2/0', 'Joint Schedule 1 (Definitions)'),
        ('joint-schedule-1/table-0/2/1', 'Joint Schedule 1 (Definitions)'),
        ('joint-schedule-1/table-0/3/0', 'Joint Schedule 1 (Definitions)'),
        ('joint-schedule-1/table-0/3/1', 'Joint Schedule 1 (Definitions)'),
    ],
)

CHECKS = (
    [('check', 'VARCHAR'), ('path', 'VARCHAR'), ('against', 'VARCHAR'), ('explained_by', 'VARCHAR')],
    [
        ('extent_nests', 'call-off-schedule-9/a/3', 'call-off-schedule-9/a', None),
        ('extent_nests', 'call-off-schedule-9/a/3/3.4', 'call-off-schedule-9/a/3', None),
        ('extent_nests', 'call-off-schedule-9/b/2', 'call-off-schedule-9/b', None),
        ('extent_nests', 'call-off-schedule-9/b/3', 'call-off-schedule-9/b', None),
        ('extent_nests', 'call-off-schedule-9/b/3/3.4', 'call-off-schedule-9/b/3', None),
        ('extent_nests', 'call-off-schedule-9/b/annex-1', 'call-off-schedule-9/b', None),
        ('extent_nests', 'core-terms/1/1.1', 'core-terms/1', None),
        ('extent_nests', 'core-terms/1/1.1/a', 'core-terms/1/1.1', None),
        ('extent_nests', 'core-terms/1/1.1/b', 'core-terms/1/1.1', None),
        ('extent_nests', 'core-terms/1/1.1/intro', 'core-terms/1/1.1', None),
        ('extent_nests', 'core-terms/1/1.2', 'core-terms/1', None),
        ('extent_nests', 'core-terms/2/2.1', 'core-terms/2', None),
        ('extent_nests', 'core-terms/2/2.1/a', 'core-terms/2/2.1', None),
        ('extent_nests', 'core-terms/2/2.1/b', 'core-terms/2/2.1', None),
        ('extent_nests', 'core-terms/2/2.3', 'core-terms/2', None),
        ('extent_nests', 'joint-schedule-1/table-0/0/0', 'joint-schedule-1/table-0', None),
        ('extent_nests', 'joint-schedule-1/table-0/0/1', 'joint-schedule-1/table-0', None),
        ('extent_nests', 'joint-schedule-1/table-0/1/0', 'joint-schedule-1/table-0', None),
        ('extent_nests', 'joint-schedule-1/table-0/1/1', 'joint-schedule-1/table-0', None),
        ('extent_nests', 'joint-schedule-1/table-0/2/0', 'joint-schedule-1/table-0', None),
        ('extent_nests', 'joint-schedule-1/table-0/2/1', 'joint-schedule-1/table-0', None),
        ('extent_nests', 'joint-schedule-1/table-0/3/0', 'joint-schedule-1/table-0', None),
        ('extent_nests', 'joint-schedule-1/table-0/3/1', 'joint-schedule-1/table-0', None),
        ('numbering_gap', 'core-terms/2/2.3', None, 'numbering_gap: 2.2 is not printed'),
    ],
)

EMBEDDING_PLAN = (
    [('path', 'VARCHAR'), ('level', 'VARCHAR')],
    [
        ('call-off-schedule-9', 'summary'),
        ('call-off-schedule-9/a', 'subtree'),
        ('call-off-schedule-9/a/3', 'subtree'),
        ('call-off-schedule-9/a/3/3.4', 'leaf'),
        ('call-off-schedule-9/b', 'subtree'),
        ('call-off-schedule-9/b/2', 'leaf'),
        ('call-off-schedule-9/b/3', 'subtree'),
        ('call-off-schedule-9/b/3/3.4', 'leaf'),
        ('call-off-schedule-9/b/annex-1', 'leaf'),
        ('core-terms', 'summary'),
        ('core-terms/1', 'subtree'),
        ('core-terms/1/1.1', 'subtree'),
        ('core-terms/1/1.1/a', 'leaf'),
        ('core-terms/1/1.1/b', 'leaf'),
        ('core-terms/1/1.1/intro', 'leaf'),
        ('core-terms/1/1.2', 'leaf'),
        ('core-terms/2', 'subtree'),
        ('core-terms/2/2.1', 'subtree'),
        ('core-terms/2/2.1/a', 'leaf'),
        ('core-terms/2/2.1/b', 'leaf'),
        ('core-terms/2/2.3', 'leaf'),
        ('core-terms/3', 'leaf'),
        ('core-terms/preamble', 'leaf'),
        ('form-1', 'summary'),
        ('form-1/1', 'leaf'),
        ('form-1/2', 'leaf'),
        ('joint-schedule-1', 'summary'),
        ('joint-schedule-1/1', 'leaf'),
        ('joint-schedule-1/table-0', 'subtree'),
        ('joint-schedule-1/table-0/0/0', 'leaf'),
        ('joint-schedule-1/table-0/0/1', 'leaf'),
        ('joint-schedule-1/table-0/1/0', 'leaf'),
        ('joint-schedule-1/table-0/1/1', 'leaf'),
        ('joint-schedule-1/table-0/2/0', 'leaf'),
        ('joint-schedule-1/table-0/2/1', 'leaf'),
        ('joint-schedule-1/table-0/3/0', 'leaf'),
        ('joint-schedule-1/table-0/3/1', 'leaf'),
    ],
)

EDGES = (
    [('type', 'VARCHAR'), ('n', 'BIGINT')],
    [
        ('CANDIDATE', 4),
        ('CONTAINS', 33),
        ('NEXT', 20),
        ('RESOLVES_TO', 12),
    ],
)

FIND = (
    [('path', 'VARCHAR'), ('field', 'VARCHAR'), ('surface', 'VARCHAR'), ('score', 'DOUBLE')],
    [
        ('core-terms/1/1.1/b', 'text', 'comply with Law. Section 55 of the Patents Act 1977 and Regulation (EU) 2016/679 apply.', 0.52),
        ('core-terms/2/2.1/a', 'text', 'The Buyer pays the Charges within thirty days.', 0.855),
        ('core-terms/2/2.3', 'text', 'The Buyer may withhold Charges under Framework Schedule 4.', 0.9),
        ('form-1/1', 'title', 'Agent', 0.54),
        ('form-1/2', 'title', 'Notes', 0.514),
        ('joint-schedule-1/table-0/1/0', 'text', '"Charges"', 0.788),
        ('joint-schedule-1/table-0/1/1', 'term', 'Charges', 0.9),
        ('joint-schedule-1/table-0/3/1', 'term', 'Widget', 0.6),
    ],
)

DEFINE = (
    [('term', 'VARCHAR'), ('scope', 'VARCHAR'), ('path', 'VARCHAR'), ('gap', 'VARCHAR'), ('governs', 'VARCHAR')],
    [
        ('Key Performance Indicator', 'document', 'joint-schedule-1/table-0/2/1', None, 'call-off-schedule-9,core-terms,form-1,joint-schedule-1'),
    ],
)

REVIEW = (
    [('kind', 'VARCHAR'), ('part', 'VARCHAR'), ('page', 'INTEGER'), ('id', 'VARCHAR'), ('question', 'VARCHAR')],
    [
        ('anomaly', 'core-terms', 1, 'core-terms/2/2.3#0', 'numbering_gap: 2.2 is not printed'),
        ('anomaly', 'form-1', 4, 'form-1/2#0', "stray_character: 'nsert' for 'Insert'"),
        ('ref', 'call-off-schedule-9', 3, 'call-off-schedule-9/b/2/ref@3-16', 'this Schedule'),
        ('ref', 'core-terms', 1, 'core-terms/1/1.1/intro/ref@38-48', '2.1 to 2.3'),
        ('ref', 'core-terms', 1, 'core-terms/1/1.1/intro/ref@62-63', '6'),
        ('ref', 'core-terms', 1, 'core-terms/1/1.2/ref@0-11', 'This Clause'),
        ('ref', 'core-terms', 1, 'core-terms/1/1.2/ref@16-29', 'that Schedule'),
        ('ref', 'core-terms', 1, 'core-terms/2/2.1/b/ref@41-44', '9.9'),
        ('ref', 'core-terms', 1, 'core-terms/2/2.3/ref@56-57', '4'),
        ('ref', 'joint-schedule-1', 2, 'joint-schedule-1/table-0/1/1/ref@34-35', '4'),
        ('term', 'call-off-schedule-9', 3, 'call-off-schedule-9/b/3/3.4#Key Performance Indicator#57', 'sentence_initial: Key Performance Indicator'),
        ('term', 'call-off-schedule-9', 3, 'call-off-schedule-9/b/3/3.4#Supplier#81', 'sentence_initial: Supplier'),
    ],
)

BLOCKS = (
    [('part', 'VARCHAR'), ('path', 'VARCHAR'), ('parent_path', 'VARCHAR'), ('kind', 'VARCHAR'), ('label', 'VARCHAR'), ('title', 'VARCHAR'), ('text', 'VARCHAR'), ('depth', 'INTEGER'), ('ord', 'INTEGER'), ('sib_no', 'INTEGER'), ('page_start', 'INTEGER'), ('page_end', 'INTEGER')],
    [
        ('core-terms', 'core-terms', None, 'part', None, None, None, 0, 0, 0, None, None),
        ('core-terms', 'core-terms/1', 'core-terms', 'clause', '1', 'Supply', None, 1, 1, 0, 1, 1),
        ('core-terms', 'core-terms/1/1.1', 'core-terms/1', 'subclause', '1.1', None, None, 2, 2, 0, 1, 1),
        ('core-terms', 'core-terms/1/1.1/a', 'core-terms/1/1.1', 'item', 'a', None, 'by road; or', 4, 4, 1, 1, 1),
        ('core-terms', 'core-terms/1/1.1/b', 'core-terms/1/1.1', 'item', 'b', None, 'by rail.', 4, 5, 2, 1, 1),
        ('core-terms', 'core-terms/1/1.1/intro', 'core-terms/1/1.1', 'intro', None, None, 'The Supplier delivers widgets in good time.', 3, 3, 0, 1, 1),
        ('core-terms', 'core-terms/1/1.2', 'core-terms/1', 'subclause', '1.2', None, 'Delivery is free.', 2, 6, 1, 2, 2),
        ('core-terms', 'core-terms/2', 'core-terms', 'clause', '2', 'Price', None, 1, 7, 1, 2, 2),
        ('core-terms', 'core-terms/2/2.1', 'core-terms/2', 'subclause', '2.1', None, 'The Buyer pays. § 2.2 odd', 2, 8, 0, 2, 2),
        ('joint-schedule-1', 'joint-schedule-1', None, 'part', None, None, None, 0, 0, 0, None, None),
        ('joint-schedule-1', 'joint-schedule-1/1', 'joint-schedule-1', 'clause', '1', 'Meanings', None, 1, 1, 0, 3, 3),
        ('joint-schedule-1', 'joint-schedule-1/1/1.1', 'joint-schedule-1/1', 'subclause', '1.1', None, None, 2, 2, 0, 3, 3),
        ('joint-schedule-1', 'joint-schedule-1/1/1.1/1.1.1.1', 'joint-schedule-1/1/1.1', 'item', '1.1.1.1', None, 'deep number', 4, 4, 1, 3, 3),
        ('joint-schedule-1', 'joint-schedule-1/1/1.1/intro', 'joint-schedule-1/1/1.1', 'intro', None, None, 'A widget is a part.', 3, 3, 0, 3, 3),
        ('joint-schedule-1', 'joint-schedule-1/1/1.2', 'joint-schedule-1/1', 'subclause', '1.2', None, 'A part is a thing. 12) stray', 2, 5, 1, 4, 4),
        ('joint-schedule-1', 'joint-schedule-1/2', 'joint-schedule-1', 'clause', '2', 'Last', None, 1, 6, 1, 4, 4),
    ],
)
