"""The default rules of the classifier: wording of questions about a dose, as data.

``RULES`` is text: a line ``name:`` begins an entry, its lines are put together without line breaks or
leading blanks. ``{NAME}`` stands for an entry of ``PARTS``, ``{T}`` for the names of the target, ``{S}`` for those
of the medicine that comes before it.
"""

from __future__ import annotations

# All patterns of this module, which results depend on letter by letter.
PARTS_TEXT = r"""
NUMBER_WORD:
    (?:\d+(?:\.\d+)?|a|an|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve)
AGO:
    {NUMBER_WORD}\s*(?:minutes?|mins?|hours?|hrs?|days?)\s*ago
CLOCK:
    at\s+\d{1,2}(?::\d{2})?\s*(?:a\.?m\.?|p\.?m\.?)?
TIME:
    \b(?:{AGO}|{CLOCK}|earlier|today|tonight|this\s+morning|this\s+afternoon|last\s+night|yesterday|
    last\s+dose|previous\s+dose|next\s+dose|again|another\s+dose|how\s+long|how\s+soon|when\s+can)\b
ELAPSED:
    \b(?:{AGO}|{CLOCK}|earlier|today|tonight|tomorrow|right\s+now|this\s+morning|this\s+afternoon|last\s+night|yesterday|
    last\s+dose|previous\s+dose|next\s+dose)\b
EXCLUDED_INTENT:
    \b(?:alcohol|beer|wine|liquor|drink|drinks|drank|drinking|drunk|hangover|cbd|cannabis|weed|marijuana|different\s+(?:drug|medicine|medication))\b
TRANSITION:
    \b(?:mix(?:ed|ing)?\s+with|combin(?:e|ing)|substitut(?:e|ing)|replac(?:e|ing))\b
REPLACEMENT:
    \b(?:substitut(?:e|ing)|replac(?:e|ing))\b
COMBINATION:
    \b(?:mix(?:ed|ing)?\s+with|combin(?:e|ing))\b
TIMING:
    \b(?:alternat(?:e|ing)|after|before|wait|between|interval|gap|schedule|another|next|second|again|every\s+\d+(?:\.\d+)?\s*(?:hours?|hrs?))\b
SWITCH:
    \b(?:switch(?:ing)?|alternat(?:e|ing)|instead\s+of|replac(?:e|ing)|substitut(?:e|ing))\b
ROLE_VERB:
    \b(?:took|taken|used|swallowed|ingested|had)\b
ROLE_SWITCH:
    \b(?:switch(?:ing)?|replac(?:e|ing)|substitut(?:e|ing)|instead\s+of|mix(?:ed|ing)?\s+with|combin(?:e|ing))\b
ORDER:
    \b(?:after|before|then)\b
FIRST_FAILED:
    \bfirst\b.{0,80}\b(?:did(?:n't|\s+not)\s+work|wasn't\s+enough|dose|tablet|pill)\b
LEAD:
    (?:\b(?:can|could|should|may)\s+(?:i|we|you|he|she|they|one|someone)\b|
    \bwould\b(?=\s+(?:(?:i|we|you|he|she|they|one|someone)\b|(?:taking|having|using)\b))|
    \b(?:am\s+i|are\s+(?:we|you|they)|is\s+it)\b|\bwhen\s+(?:can|could|should|may|would|is|do)\b|\bhow\s+(?:soon|long)\b)
REPEAT:
    (?:again|(?<!no\s)(?<!not\s)more|another(?:\s+(?:dose|pill|tablet|capsule|time))?|next(?:\s+(?:dose|pill|tablet|capsule))?|
    second(?:\s+(?:dose|pill|tablet|capsule|time|gram))?|re[-\s]?(?:take|dose))
REPEAT_GAP:
    \s+(?:(?:\d+(?:\.\d+)?\s*(?:mg|milligrams?|g|grams?)\s*)?(?:of\s+)?)
ACTION:
    (?:take|taking|use|using|dose|dosing|pill|tablet|capsule|gram|re[-\s]?(?:take|dose))
SAFETY:
    (?:safe|ok(?:ay)?|alright|dangerous|recommended)
SAFETY_WORD:
    \b{SAFETY}\b
UNIT:
    (?:mg|milligrams?|g|grams?|tablets?|pills?|caplets?|capsules?|doses?)
AMOUNT_CUE:
    (?:take|taking|have|use|using|safe|ok(?:ay)?|alright|too\s+much|overdose|mg|milligrams?|grams?|dose|dosage|per\s+day|a\s+day|daily|
    at\s+once|in\s+24\s*(?:hours?|hrs?)|each\s+time|max(?:imum)?)
PRIOR_VERB:
    (?<!haven't\s)(?<!hasn't\s)(?<!hadn't\s)(?<!not\s)(?<!never\s)(?:took|taken|used|swallowed|ingested)
TOOK:
    \b(?:take|taking|took|have|having|had|use|using|used)\b
QUESTION:
    (?:\?|{LEAD}|\b(?:safe|ok(?:ay)?|alright|dangerous)\s+to\b)
QUESTION_ACTION:
    \b{ACTION}\b|\b(?:have|having|had|swallow(?:ed|ing)?|ingest(?:ed|ing)?)\b
DECISION:
    (?:\?|{LEAD}|\bdo\s+(?:i|we|you|they)\b|\b(?:safe|ok(?:ay)?|alright|dangerous|recommended)\b)
DOSES_OF:
    (?:{T}.{0,30}\bdoses?\b|\bdoses?\b.{0,30}{T})
NEAR_DOSES:
    (?:{T}.{0,35}\bdoses?\b|\bdoses?\b.{0,35}{T})
IT:
    (?:{T}|\bit\b|\bone\b|\bmore\b)
"""

RULES_TEXT = r"""
prior:
    (?:\b(?:i|we|he|she|they)\b.{0,30}\b{PRIOR_VERB}\b.{0,100}{T}|
    \b{PRIOR_VERB}\b.{0,100}{T}|
    \b(?:i|we|he|she|they)\s+had\b.{0,45}{T}|
    \b(?:last|previous|first)\s+(?:dose|tablet|pill|capsule)\b.{0,80}{T}|
    {T}.{0,60}(?:\b(?:dose|tablet|pill|capsule|took|taken|used)\b|\b\d+(?:\.\d+)?\s*(?:mg|milligrams?)\b).{0,60}
    \b(?:ago|earlier|already|last\s+night|this\s+morning|yesterday|last\s+dose|previous\s+dose)\b)
contextual_prior:
    (?:\b{PRIOR_VERB}\b.{0,140}{T}|
    \b(?:i|we|he|she|they)\s+had\b.{0,60}{T}|
    {T}.{0,90}(?:\b(?:dose|tablet|pill|capsule|took|taken|used)\b|\b\d+(?:\.\d+)?\s*(?:mg|milligrams?)\b).{0,90}
    \b(?:ago|earlier|already|today|tonight|last\s+night|this\s+morning|yesterday|last\s+dose|previous\s+dose)\b|
    \bafter\s+{T}\b|
    \bafter\b.{0,30}\b(?:taking|took|having|had|using|used)\b.{0,50}{T})
contextual_repeat:
    (?:\b(?:again|re[-\s]?(?:take|dose))\b.{0,70}{T}|
    {T}.{0,70}\b(?:again|another\s+time|one\s+more)\b|
    \b(?:another|next|second|one\s+more)\b.{0,55}(?:\b(?:dose|pill|tablet|capsule)\b.{0,25})?{T}|
    \bmore\s+(?:(?:\d+(?:\.\d+)?\s*(?:mg|milligrams?)\s+)?(?:of\s+)?)?{T}|
    \b(?:another|next|second)\s+(?:dose|pill|tablet|capsule)\b.{0,30}(?:of\s+)?{T}|
    \bre[-\s]?(?:take|dose)\b.{0,60}{T})
contextual_followup:
    (?:\b(?:take|have|use)\b.{0,30}\b(?:another|next|second)\s+(?:dose|pill|tablet|capsule)\b|
    \b(?:take|have|use)\b.{0,30}\bone\s+more\b(?:.{0,20}(?:{T}|\b(?:dose|pill|tablet|capsule)\b))?|
    \btake\s+more\b(?:.{0,25}{T})?|
    \b(?:take|have|use)\b.{0,45}(?:{T}|\bit\b|\bone\b).{0,35}\b(?:again|now|today|tonight)\b|
    \b(?:again|now|today|tonight)\b.{0,45}\b(?:take|have|use)\b.{0,45}{IT}|
    \bwait\b.{0,100}\b(?:another|next|second)\s+(?:dose|pill|tablet|capsule)\b)
contextual_interval:
    (?:\bhow\s+(?:long|soon|many\s+hours|much\s+time)\b.{0,140}\bafter\b.{0,90}(?:{TOOK}.{0,55})?{T}.{0,140}\b(?:take|have|use)\b.{0,55}{IT}|
    \bhow\s+(?:long|soon|many\s+hours|much\s+time)\b.{0,140}\bwait\b.{0,100}\b(?:before|until)\b.{0,80}\b(?:take|have|use)\b.{0,55}{IT}|
    \b(?:gap|interval)\b.{0,100}\bbetween\b.{0,80}{NEAR_DOSES}|
    \bbetween\b.{0,80}{NEAR_DOSES}|
    \b{T}\b.{0,55}\bdoses?\s+apart\b)
dosing_amount_question:
    (?:\bhow\s+(?:much|many)\b[^?.!]{0,55}{T}[^?.!]{0,45}\b{AMOUNT_CUE}\b|
    \bhow\s+(?:much|many)\b[^?.!]{0,25}\b{AMOUNT_CUE}\b[^?.!]{0,45}{T}|
    \b(?:max(?:imum)?|safe|recommended|normal|right|correct|proper|highest|daily|single)\b[^?.!]{0,25}\b(?:dose|dosage|amount|limit)\b[^?.!]{0,45}{T}|
    {T}[^?.!]{0,45}\b(?:max(?:imum)?|safe|recommended|highest|daily|single)\b[^?.!]{0,25}\b(?:dose|dosage|amount|limit)\b|
    {LEAD}[^?.!]{0,45}\b(?:take|have|use)\b[^?.!]{0,30}\d+(?:\.\d+)?\s*{UNIT}[^?.!]{0,25}(?:of\s+)?{T}|
    \bis\b[^?.!]{0,20}\d+(?:\.\d+)?\s*{UNIT}[^?.!]{0,25}(?:of\s+)?{T}[^?.!]{0,45}\b(?:safe|too\s+much|ok(?:ay)?|alright|fine|enough|dangerous|overdose)\b|
    {T}[^?.!]{0,30}\bis\b[^?.!]{0,20}\d+(?:\.\d+)?\s*{UNIT}[^?.!]{0,35}\b(?:safe|too\s+much|ok(?:ay)?|alright|fine|enough|dangerous)\b)
explicit_same_medicine_repeat_question:
    (?:{LEAD}[^?!.]{0,90}\b{ACTION}\b[^?!.]{0,25}(?:\b{REPEAT}\b{REPEAT_GAP}{T}|{T}\s+\b(?:again|another\s+time)\b)|
    {LEAD}[^?!.]{0,100}\bre[-\s]?(?:take|dose)\b[^?!.]{0,45}{T}|
    (?:^|[?!.]\s+)\bis\b[^?!.]{0,45}(?:\b{ACTION}\b[^?!.]{0,35})?\b{REPEAT}\b{REPEAT_GAP}{T}[^?!.]{0,60}\b{SAFETY}\b)
same_medicine_interval_question:
    (?:\bhow\s+(?:long|soon|many\s+hours|much\s+time)\b[^?]{0,90}\bafter\b[^?]{0,70}(?:{TOOK}[^?]{0,45})?{T}[^?]{0,110}
    (?:\b(?:can|could|should|may|would)\s+(?:i|we|you|he|she|they|one)\b|\bdo\s+(?:i|we|you|they)\b)[^?]{0,45}
    \b(?:take|have|use)\b\s+(?:(?:the|some)\s+)?(?:{T}|\bit\b|\bone\b)|
    \b(?:is\s+it\s+)?(?:safe|dangerous|ok(?:ay)?)\b.{0,100}\bwait\b.{0,70}\bbetween\b.{0,60}{DOSES_OF})
when_take_same_medicine_again:
    \bwhen\s+(?:can|could|should|may)\s+i\s+(?:safely\s+)?(?:take|have|use)\b.{0,50}{T}.{0,30}\bagain\b
wait_after_same_medicine_dose:
    \bhow\s+(?:long|soon|many\s+hours|much\s+time)\b.{0,100}\bafter\b.{0,50}{TOOK}.{0,50}{T}.{0,120}
    \b(?:take|have|use)\b.{0,50}(?:{T}|\bit\b).{0,30}\bagain\b
wait_before_same_medicine_again:
    \bhow\s+(?:long|soon|many\s+hours|much\s+time)\b.{0,100}\bwait\b.{0,80}\b(?:before|until)\b.{0,60}
    \b(?:take|taking|have|having|use|using)\b.{0,45}{T}.{0,25}\b(?:again|next)\b
take_more_same_medicine:
    \b(?:can|could|should|may)\s+i\s+(?:safely\s+|still\s+|now\s+)?(?:take|have|use)\b.{0,45}
    (?:\bmore\b.{0,25}{T}|\banother\b.{0,55}{T}|{T}.{0,30}\b(?:again|another\s+time)\b)
safe_to_take_same_medicine_again:
    \bis\s+it\s+(?:safe|ok(?:ay)?|alright)\b.{0,120}\b(?:take|have|use)\b.{0,50}{T}.{0,30}\b(?:again|now|another\s+time)\b
interval_between_same_medicine_doses:
    (?:\b(?:safe|minimum|recommended|right)\s+(?:time\s+)?(?:gap|interval)\b.{0,100}\bbetween\b.{0,60}{DOSES_OF}|
    \bhow\s+(?:many\s+hours|much\s+time|long)\b.{0,100}\bbetween\b.{0,60}{DOSES_OF})
one_brand_to_another_same_medicine:
    \bhow\s+(?:long|soon|much\s+time)\b.{0,100}\bafter\b.{0,60}\b(?:take|taking|took)\b.{0,60}{T}.{0,100}
    \b(?:take|taking)\b.{0,50}\banother\b.{0,50}\bbrand\b
consecutive_same_medicine_doses:
    \bhow\s+(?:long|soon|many\s+hours|much\s+time)\b.{0,100}\b(?:wait|before|between)\b.{0,80}
    \b(?:take|taking)?\b.{0,30}\bconsecutive\b.{0,40}{T}.{0,30}\bdoses?\b
same_ingredient_product_interval:
    \bhow\s+(?:long|soon|many\s+hours|much\s+time)\b.{0,100}\bafter\b.{0,60}\b(?:take|taking|took)\b.{0,70}
    \b(?:medication|medicine|product|brand)\b.{0,40}\bwith\b.{0,30}{T}.{0,100}\b(?:before|until)\b.{0,50}\b(?:take|taking)\b.{0,40}\banother\b
prior_dose_then_another_dose:
    \b(?:can|could|should|may)\s+i\b.{0,100}\b(?:take|have|use)\b.{0,45}\b(?:another|next|second|more)\b.{0,35}\b(?:dose|pill|tablet|capsule)s?\b
prior_dose_then_wait_for_next:
    \b(?:how\s+(?:long|soon)|when\s+(?:can|could|should)\s+i)\b.{0,120}\b(?:wait|take|have|use)\b.{0,60}
    \b(?:another|next|second)\b.{0,30}\b(?:dose|pill|tablet|capsule)s?\b
prior_dose_then_take_now:
    (?:{LEAD}.{0,100}\b(?:take|have|use)\b\s+(?:(?:the|some)\s+)?{IT}.{0,35}\b(?:now|today|tonight)\b|
    \b(?:am\s+i|is\s+it|would\s+it)\b.{0,55}\b{SAFETY}\b.{0,70}\b(?:take|have|use)\b\s+(?:(?:the|some)\s+)?{IT}.{0,35}\b(?:now|today|tonight|again)\b)
switch_between_target_medicines:
    (?:{LEAD}[^?]{0,100}\bswitch(?:ing)?\s+from\s+{S}\s+to\s+{T}\b|
    \bis\s+switching\s+from\s+{S}\s+to\s+{T}.{0,50}\b{SAFETY}\b)
replace_between_target_medicines:
    (?:{LEAD}[^?]{0,100}\breplac(?:e|ing)\b.{0,35}{S}.{0,25}\bwith\b.{0,25}{T}|
    {LEAD}[^?]{0,100}\bsubstitut(?:e|ing)\b.{0,35}{S}.{0,25}\bwith\b.{0,25}{T}|
    {LEAD}[^?]{0,100}\bsubstitut(?:e|ing)\b.{0,35}{T}.{0,25}\bfor\b.{0,25}{S}|
    \bis\b[^?]{0,50}\breplacing\b.{0,35}{S}.{0,25}\bwith\b.{0,25}{T}.{0,50}\b{SAFETY}\b)
take_target_instead_of_other_target:
    (?:{LEAD}[^?]{0,100}\b(?:take|have|use|taking|having|using)\b.{0,45}{T}.{0,40}\binstead\s+of\b.{0,40}{S}|
    \bis\b.{0,30}\b(?:taking|having|using)\b.{0,45}{T}.{0,40}\binstead\s+of\b.{0,40}{S}.{0,50}\b{SAFETY}\b)
alternate_between_target_medicines:
    (?:{LEAD}[^?]{0,100}\balternat(?:e|ing)\b.{0,35}{S}.{0,35}(?:and|with)\s+{T}|
    \bis\b.{0,40}\balternating\b.{0,35}{S}.{0,35}(?:and|with)\s+{T}.{0,50}\b{SAFETY}\b)
prior_target_then_other_target:
    \b(?:i|we|he|she|they)\b.{0,30}\b(?:{PRIOR_VERB}|had)\b.{0,90}{S}.{0,180}
    (?:{LEAD}.{0,90}\b(?:take|have|use)\b.{0,55}{T}|\b(?:is|would)\b.{0,40}{T}.{0,45}\b{SAFETY}\b)
interval_between_target_medicines:
    (?:\bhow\s+(?:long|soon|many\s+hours|much\s+time)\b.{0,100}\bafter\b.{0,70}(?:{TOOK}.{0,50})?{S}.{0,130}
    (?:\b(?:can|could|should|may|would|do)\b.{0,55})?\b(?:take|taking|have|having|use|using)\b.{0,50}{T}|
    {LEAD}.{0,100}\b(?:take|have|use|taking|having|using)\b.{0,50}{T}.{0,100}\bafter\b.{0,90}(?:{TOOK}.{0,45})?{S})
between_targets:
    \bbetween\b.{0,80}{S}.{0,45}(?:and|with)\s+{T}
"""

#: Which rules there are of each sort, in the order in which they are tried.
SWITCHES = (
    "switch_between_target_medicines",
    "replace_between_target_medicines",
    "take_target_instead_of_other_target",
    "alternate_between_target_medicines",
    "prior_target_then_other_target",
    "interval_between_target_medicines",
)
EXPLICIT = (
    "explicit_same_medicine_repeat_question",
    "same_medicine_interval_question",
    "when_take_same_medicine_again",
    "wait_after_same_medicine_dose",
    "wait_before_same_medicine_again",
    "take_more_same_medicine",
    "safe_to_take_same_medicine_again",
    "interval_between_same_medicine_doses",
    "one_brand_to_another_same_medicine",
    "consecutive_same_medicine_doses",
    "same_ingredient_product_interval",
)
IMPLICIT = ("prior_dose_then_another_dose", "prior_dose_then_wait_for_next", "prior_dose_then_take_now")
#: Explicit rules that need an earlier dose of the target in the window.
NEED_PRIOR = frozenset(("when_take_same_medicine_again", "wait_before_same_medicine_again", "take_more_same_medicine", "safe_to_take_same_medicine_again"))
#: Switch rules whose whole match tells of the earlier dose.
TELL_PRIOR = frozenset(("prior_target_then_other_target", "interval_between_target_medicines"))


def entries(text: str) -> dict[str, str]:
    """The entries of a text as written above."""
    out: dict[str, str] = {}
    name = ""
    for line in text.splitlines():
        if line and not line[0].isspace():
            name = line.rstrip(":")
            out[name] = ""
        elif line:
            out[name] += line.strip()
    return out


def expanded(pattern: str, parts: dict[str, str]) -> str:
    """``pattern`` with the parts it names put in, also those that parts name."""
    for name, part in parts.items():
        if "{" + name + "}" in pattern:
            pattern = pattern.replace("{" + name + "}", expanded(part, parts))
    return pattern


PARTS = entries(PARTS_TEXT)
RULES = {name: expanded(source, PARTS) for name, source in entries(RULES_TEXT).items()}
QUESTION = expanded(PARTS["QUESTION"], PARTS)
