"""License scan: ordered signature rules behind a keyword gate; priority and interval containment settle overlaps.

Rules are hand-written signatures of license texts and notices, and forms of license names in common phrasings. The
literals that every match of a rule must hold are read off its pattern; one pass of an automaton finds the literals of a
document, and only rules whose literals are all there run. A detection that lies within another of the same or higher
priority is dropped; others stand, also where they overlap in part.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from re import _constants as op
from re import _parser

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import WORD_BYTE, arrow_rows, text_bytes

# Phrases and their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
_SEPARATOR = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_WORD = rb"[0-9a-z\x80-\xff]"
_BASE = [(label, phrase.split()[-1].encode(), re.compile(rb"(?<!" + _WORD + rb")" + _SEPARATOR.join(phrase.encode().split()) + rb"(?!" + _WORD + rb")")) for phrase, label in BASE]

#: Families: label, name as a regex, versions (or none), short form as a regex.
FAMILIES = (
    ("gpl", r"gnu\s+general\s+public\s+licen[sc]e", ("1.0", "2.0", "3.0"), r"gpl"),
    ("lgpl", r"gnu\s+(?:lesser|library)\s+general\s+public\s+licen[sc]e", ("2.0", "2.1", "3.0"), r"lgpl"),
    ("agpl", r"gnu\s+affero\s+general\s+public\s+licen[sc]e", ("1.0", "3.0"), r"agpl"),
    ("gfdl", r"gnu\s+free\s+documentation\s+licen[sc]e", ("1.1", "1.2", "1.3"), r"gfdl"),
    ("apache", r"apache\s+(?:software\s+)?licen[sc]e", ("1.0", "1.1", "2.0"), r"apache"),
    ("mit", r"(?:the\s+)?mit\s+licen[sc]e", (), r"mit"),
    ("bsd", r"(?:new\s+|modified\s+|simplified\s+|original\s+)?bsd\s+licen[sc]e", (), r"bsd"),
    ("bsd-2-clause", r"bsd\s+2[\s-]clause(?:\s+licen[sc]e)?", (), r"bsd-2-clause"),
    ("bsd-3-clause", r"bsd\s+3[\s-]clause(?:\s+licen[sc]e)?", (), r"bsd-3-clause"),
    ("mpl", r"mozilla\s+public\s+licen[sc]e", ("1.0", "1.1", "2.0"), r"mpl"),
    ("epl", r"eclipse\s+public\s+licen[sc]e", ("1.0", "2.0"), r"epl"),
    ("cddl", r"common\s+development\s+and\s+distribution\s+licen[sc]e", ("1.0", "1.1"), r"cddl"),
    ("cpl", r"common\s+public\s+licen[sc]e", ("1.0",), r"cpl"),
    ("eupl", r"european\s+union\s+public\s+licen[sc]e", ("1.0", "1.1", "1.2"), r"eupl"),
    ("artistic", r"artistic\s+licen[sc]e", ("1.0", "2.0"), r"artistic"),
    ("bsl", r"boost\s+software\s+licen[sc]e", ("1.0",), r"bsl"),
    ("busl", r"business\s+source\s+licen[sc]e", ("1.0", "1.1"), r"busl"),
    ("isc", r"isc\s+licen[sc]e", (), r"isc"),
    ("zlib", r"zlib\s+licen[sc]e", (), r"zlib"),
    ("unlicense", r"the\s+unlicense", (), r"unlicense"),
    ("wtfpl", r"do\s+what\s+the\s+fuck\s+you\s+want\s+to\s+public\s+licen[sc]e", ("1", "2"), r"wtfpl"),
    ("ofl", r"sil\s+open\s+font\s+licen[sc]e", ("1.0", "1.1"), r"ofl"),
    ("python", r"python\s+software\s+foundation\s+licen[sc]e", ("2",), r"psf"),
    ("sspl", r"server\s+side\s+public\s+licen[sc]e", ("1",), r"sspl"),
    ("ms-pl", r"microsoft\s+public\s+licen[sc]e", (), r"ms-pl"),
    ("cecill", r"cecill\s+(?:free\s+software\s+)?licen[sc]e", ("1.0", "2.0", "2.1"), r"cecill"),
    ("cc-by", r"creative\s+commons\s+attribution(?:\s+licen[sc]e)?", ("2.0", "2.5", "3.0", "4.0"), r"cc[\s-]by"),
    ("cc-by-sa", r"creative\s+commons\s+attribution[\s-]+share\s?alike", ("2.0", "2.5", "3.0", "4.0"), r"cc[\s-]by-sa"),
    ("cc-by-nc", r"creative\s+commons\s+attribution[\s-]+non-?commercial", ("2.0", "2.5", "3.0", "4.0"), r"cc[\s-]by-nc"),
    ("cc-by-nd", r"creative\s+commons\s+attribution[\s-]+no\s?-?derivatives", ("2.0", "2.5", "3.0", "4.0"), r"cc[\s-]by-nd"),
    ("cc-by-nc-sa", r"creative\s+commons\s+attribution[\s-]+non-?commercial[\s-]+share\s?alike", ("2.0", "2.5", "3.0", "4.0"), r"cc[\s-]by-nc-sa"),
    ("cc-by-nc-nd", r"creative\s+commons\s+attribution[\s-]+non-?commercial[\s-]+no\s?-?derivatives", ("2.0", "2.5", "3.0", "4.0"), r"cc[\s-]by-nc-nd"),
    ("cc0", r"creative\s+commons\s+zero", ("1.0",), r"cc0"),
    ("public-domain", r"(?:dedicated\s+to|released\s+into|in)\s+the\s+public\s+domain", (), r"public-domain"),
    ("odbl", r"open\s+database\s+licen[sc]e", ("1.0",), r"odbl"),
    ("proprietary", r"all\s+rights\s+reserved", (), r"proprietary"),
)
# Signatures of texts and notices; label, confidence, pattern over lower-cased text, where a space stands for white space.
SIGNATURES = r"""
mit | 1.0 | permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge,?\s+to\s+any\s+person\s+obtaining\s+a\s+copy
mit | 0.9 | the\s+above\s+copyright\s+notice\s+and\s+this\s+permission\s+notice\s+shall\s+be\s+included\s+in\s+all\s+copies
mit | 0.8 | the\s+software\s+is\s+provided\s+["'\u201c]?as\s+is["'\u201d]?,\s+without\s+warranty\s+of\s+any\s+kind
mit-0 | 1.0 | mit\s+no\s+attribution
mit-modern-variant | 0.9 | mit\s+licen[sc]e\s+modern\s+variant
x11 | 0.9 | x11\s+licen[sc]e
x11 | 0.9 | except\s+as\s+contained\s+in\s+this\s+notice,\s+the\s+names?\s+of
expat | 0.9 | expat\s+licen[sc]e
isc | 1.0 | permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose\s+with\s+or\s+without\s+fee
0bsd | 1.0 | (?:bsd\s+zero\s+clause|zero[\s-]clause\s+bsd)
bsd | 0.9 | redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms,?\s+with\s+or\s+without\s+modification
bsd-2-clause | 0.9 | redistributions\s+in\s+binary\s+form\s+must\s+reproduce\s+the\s+above\s+copyright\s+notice
bsd-3-clause | 1.0 | neither\s+the\s+names?\s+of\s+.{1,200}?\s+nor\s+the\s+names\s+of\s+its\s+contributors
bsd-4-clause | 1.0 | all\s+advertising\s+materials\s+mentioning\s+features\s+or\s+use\s+of\s+this\s+software
bsd-3-clause-clear | 1.0 | no\s+express\s+or\s+implied\s+licen[sc]es\s+to\s+any\s+party's\s+patent\s+rights
bsd-style | 0.7 | bsd[\s-]style\s+licen[sc]e
apache-2.0 | 1.0 | licensed\s+under\s+the\s+apache\s+license,\s+version\s+2\.0\s+\(the\s+["'\u201c]?license["'\u201d]?\)
apache-2.0 | 1.0 | you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+license
apache-2.0 | 1.0 | apache\.org/licenses/license-2\.0
apache-2.0 | 0.9 | unless\s+required\s+by\s+applicable\s+law\s+or\s+agreed\s+to\s+in\s+writing,\s+software
apache-1.1 | 0.9 | this\s+product\s+includes\s+software\s+developed\s+by\s+the\s+apache\s+software\s+foundation
apache | 0.7 | apache[\s-]style\s+licen[sc]e
gpl | 0.9 | this\s+program\s+is\s+free\s+software[;:,]?\s+you\s+can\s+redistribute\s+it
gpl-2.0-or-later | 1.0 | either\s+version\s+2\s+of\s+the\s+license,?\s+or\s+\(?at\s+your\s+option\)?\s+any\s+later\s+version
gpl-3.0-or-later | 1.0 | either\s+version\s+3\s+of\s+the\s+license,?\s+or\s+\(?at\s+your\s+option\)?\s+any\s+later\s+version
gpl-2.0-only | 0.95 | version\s+2\s+of\s+the\s+license\s+only
gpl | 0.9 | you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+general\s+public\s+license
gpl | 0.9 | gnu\.org/licenses/gpl
gpl-2.0 | 0.9 | gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
gpl-3.0 | 0.9 | gnu\.org/licenses/gpl-3\.0
gpl | 0.7 | under\s+the\s+terms\s+of\s+the\s+gpl
gpl-classpath | 1.0 | gpl[\s-]+with[\s-]+(?:the\s+)?classpath[\s-]+exception
gpl-autoconf | 0.9 | autoconf\s+(?:configure\s+)?exception
gpl-bison | 0.9 | bison\s+(?:parser\s+)?exception
gpl-gcc | 0.9 | gcc\s+runtime\s+library\s+exception
gpl-font | 0.9 | gpl\s+font\s+exception
gpl-linking | 0.8 | linking\s+exception
lgpl | 0.9 | this\s+library\s+is\s+free\s+software[;:,]?\s+you\s+can\s+redistribute\s+it
lgpl | 0.9 | you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+(?:lesser|library)\s+general\s+public\s+license
lgpl | 0.9 | gnu\.org/licenses/lgpl
lgpl-2.1 | 0.9 | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
agpl | 0.9 | you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+affero\s+general\s+public\s+license
agpl | 0.9 | gnu\.org/licenses/agpl
agpl | 0.8 | affero\s+gpl
gfdl | 0.9 | permission\s+is\s+granted\s+to\s+copy,\s+distribute\s+and/or\s+modify\s+this\s+document
gfdl | 0.9 | gnu\.org/licenses/fdl
gfdl | 0.7 | no\s+invariant\s+sections
mpl-2.0 | 1.0 | this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla\s+public\s+license,\s+v\.\s+2\.0
mpl-1.1 | 1.0 | the\s+contents\s+of\s+this\s+file\s+are\s+subject\s+to\s+the\s+mozilla\s+public\s+license\s+version\s+1\.1
mpl-2.0 | 0.9 | mozilla\.org/mpl/2\.0
mpl | 0.8 | mozilla\.org/mpl
mpl-2.0-no-copyleft-exception | 0.9 | incompatible\s+with\s+secondary\s+licenses
epl-2.0 | 1.0 | this\s+program\s+and\s+the\s+accompanying\s+materials\s+are\s+made\s+available\s+under\s+the\s+terms\s+of\s+the\s+eclipse\s+public\s+license\s+2\.0
epl-1.0 | 0.9 | eclipse\.org/legal/epl-v10
epl-2.0 | 0.9 | eclipse\.org/legal/epl-2\.0
edl | 0.9 | eclipse\s+distribution\s+licen[sc]e
cddl | 0.9 | the\s+contents\s+of\s+this\s+file\s+are\s+subject\s+to\s+the\s+terms\s+of\s+the\s+common\s+development\s+and\s+distribution\s+license
cpl | 0.9 | opensource\.org/licenses/cpl
eupl | 0.9 | joinup\.ec\.europa\.eu/.{0,80}?eupl
artistic-2.0 | 0.9 | the\s+artistic\s+license\s+2\.0
artistic-perl | 0.9 | same\s+terms\s+as\s+perl\s+itself
bsl | 1.0 | boost\.org/license_1_0
bsl | 0.9 | distributed\s+under\s+the\s+boost\s+software\s+license
busl-1.1 | 0.9 | change\s+date\s.{0,200}?\schange\s+license
elastic-2.0 | 0.9 | elastic\s+license\s+2\.0
elastic | 0.8 | elastic\s+licen[sc]e
commons-clause | 1.0 | commons\s+clause
confluent | 0.9 | confluent\s+community\s+licen[sc]e
polyform-noncommercial | 1.0 | polyform\s+noncommercial\s+licen[sc]e
polyform-small-business | 1.0 | polyform\s+small\s+business\s+licen[sc]e
polyform-shield | 1.0 | polyform\s+shield\s+licen[sc]e
prosperity | 1.0 | prosperity\s+public\s+licen[sc]e
parity | 1.0 | parity\s+public\s+licen[sc]e
zlib | 1.0 | this\s+software\s+is\s+provided\s+'as-is',\s+without\s+any\s+express\s+or\s+implied\s+warranty
zlib | 0.9 | zlib/libpng\s+licen[sc]e
libpng | 0.9 | libpng\s+licen[sc]e
unlicense | 1.0 | this\s+is\s+free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain
unlicense | 0.9 | unlicense\.org
wtfpl | 1.0 | you\s+just\s+do\s+what\s+the\s+fuck\s+you\s+want\s+to
wtfpl | 0.9 | wtfpl\.net
ofl | 0.9 | this\s+font\s+software\s+is\s+licensed\s+under\s+the\s+sil\s+open\s+font\s+license
ofl | 0.9 | scripts\.sil\.org/ofl
ofl | 0.8 | reserved\s+font\s+name
ubuntu-font | 0.9 | ubuntu\s+font\s+licen[sc]e
bitstream-vera | 0.9 | bitstream\s+vera\s+fonts?\s+copyright
python | 0.9 | psf\s+license\s+agreement
ruby | 0.9 | (?:same\s+terms\s+as\s+ruby|ruby\s+licen[sc]e)
php | 0.9 | php\s+licen[sc]e
php-3.01 | 0.9 | this\s+source\s+file\s+is\s+subject\s+to\s+version\s+3\.01\s+of\s+the\s+php\s+license
zend | 0.9 | zend\s+(?:engine\s+)?licen[sc]e
openssl | 1.0 | this\s+product\s+includes\s+software\s+developed\s+by\s+the\s+openssl\s+project
openssl | 0.9 | openssl\s+licen[sc]e
curl | 0.9 | curl\s+licen[sc]e
postgresql | 1.0 | postgresql\s+licen[sc]e
ncsa | 1.0 | (?:university\s+of\s+illinois/)?ncsa\s+open\s+source\s+licen[sc]e
ecl-2.0 | 0.9 | educational\s+community\s+licen[sc]e
afl | 0.9 | academic\s+free\s+licen[sc]e
osl | 0.9 | open\s+software\s+licen[sc]e
ms-rl | 1.0 | microsoft\s+reciprocal\s+licen[sc]e
apsl | 1.0 | apple\s+public\s+source\s+licen[sc]e
ipl | 0.9 | ibm\s+public\s+licen[sc]e
spl | 0.9 | sun\s+public\s+licen[sc]e
npl | 0.9 | netscape\s+public\s+licen[sc]e
qpl | 0.9 | q\s+public\s+licen[sc]e
lppl | 1.0 | latex\s+project\s+public\s+licen[sc]e
w3c | 0.9 | w3c\s+software\s+(?:notice\s+and\s+)?licen[sc]e
vim | 0.9 | vim\s+licen[sc]e
beerware | 1.0 | the\s+beer-?ware\s+licen[sc]e
json | 1.0 | the\s+software\s+shall\s+be\s+used\s+for\s+good,\s+not\s+evil
json | 0.9 | json\s+licen[sc]e
mulan-psl | 1.0 | mulan\s+(?:permissive\s+software\s+licen[sc]e|psl)
blueoak | 1.0 | blue\s+oak\s+model\s+licen[sc]e
upl | 1.0 | universal\s+permissive\s+licen[sc]e
unicode | 0.8 | unicode,?\s+inc\.?\s+licen[sc]e\s+agreement
icu | 0.9 | icu\s+licen[sc]e
imagemagick | 0.9 | imagemagick\s+licen[sc]e
ijg | 0.9 | independent\s+jpeg\s+group
hpnd | 0.9 | historical\s+permission\s+notice\s+and\s+disclaimer
nvidia | 0.9 | nvidia\s+(?:software|source\s+code)\s+licen[sc]e
intel | 0.9 | intel\s+simplified\s+software\s+licen[sc]e
openrail | 0.9 | (?:creativeml\s+)?open\s*rail(?:\+\+)?-m
bigscience-rail | 1.0 | bigscience\s+(?:bloom\s+)?rail\s+licen[sc]e
llama-2 | 1.0 | llama\s+2\s+community\s+licen[sc]e
llama-3 | 1.0 | (?:meta\s+)?llama\s+3(?:\.[0-9])?\s+community\s+licen[sc]e
gemma | 0.9 | gemma\s+terms\s+of\s+use
cc-by-4.0 | 1.0 | creativecommons\.org/licenses/by/4\.0
cc-by-3.0 | 1.0 | creativecommons\.org/licenses/by/3\.0
cc-by-sa-4.0 | 1.0 | creativecommons\.org/licenses/by-sa/4\.0
cc-by-sa-3.0 | 1.0 | creativecommons\.org/licenses/by-sa/3\.0
cc-by-nc-4.0 | 1.0 | creativecommons\.org/licenses/by-nc/4\.0
cc-by-nd-4.0 | 1.0 | creativecommons\.org/licenses/by-nd/4\.0
cc-by-nc-sa-4.0 | 1.0 | creativecommons\.org/licenses/by-nc-sa/4\.0
cc-by-nc-nd-4.0 | 1.0 | creativecommons\.org/licenses/by-nc-nd/4\.0
cc0-1.0 | 1.0 | creativecommons\.org/publicdomain/zero/1\.0
cc0 | 0.9 | waived\s+all\s+copyright\s+and\s+related\s+or\s+neighboring\s+rights
public-domain-mark | 1.0 | creativecommons\.org/publicdomain/mark
public-domain | 0.8 | this\s+work\s+is\s+in\s+the\s+public\s+domain
public-domain | 0.8 | no\s+rights\s+reserved
odbl | 1.0 | opendatacommons\.org/licenses/odbl
odc-by | 1.0 | (?:opendatacommons\.org/licenses/by|open\s+data\s+commons\s+attribution)
pddl | 1.0 | (?:opendatacommons\.org/licenses/pddl|public\s+domain\s+dedication\s+and\s+licen[sc]e)
ogl-uk | 1.0 | open\s+government\s+licen[sc]e
cdla-permissive | 1.0 | community\s+data\s+licen[sc]e\s+agreement\s+[-\u2013]\s+permissive
cdla-sharing | 1.0 | community\s+data\s+licen[sc]e\s+agreement\s+[-\u2013]\s+sharing
etalab | 1.0 | licence\s+ouverte
free-art | 1.0 | (?:free\s+art\s+licen[sc]e|licence\s+art\s+libre)
datenlizenz | 1.0 | datenlizenz\s+deutschland
proprietary | 0.9 | (?:strictly\s+)?confidential\s+and\s+proprietary
proprietary | 0.9 | unauthorized\s+copying\s+of\s+this\s+file
proprietary | 0.8 | may\s+not\s+be\s+reproduced\s+(?:or\s+\w+\s+)?without\s+(?:the\s+)?(?:prior\s+)?(?:express\s+)?(?:written\s+)?permission
proprietary | 0.8 | end[\s-]user\s+licen[sc]e\s+agreement
proprietary | 0.7 | proprietary\s+licen[sc]e
proprietary | 0.7 | alle\s+rechte\s+vorbehalten
proprietary | 0.7 | tous\s+droits\s+r\u00e9serv\u00e9s
proprietary | 0.7 | todos\s+los\s+derechos\s+reservados
mit-cmu | 0.9 | permission to use, copy, modify,? and distribute this software and its documentation for any purpose and without fee is hereby granted
mit-enna | 0.9 | in the case of dissemination or publication of modified versions
mit-feh | 0.9 | copies of the software and its documentation and acknowledgment shall be given
hpnd-sell-variant | 0.9 | permission to use, copy, modify, distribute, and sell this software and its documentation for any purpose
smlnj | 0.9 | standard ml of new jersey copyright notice
ntp | 0.9 | permission to use, copy, modify, and distribute this software and its documentation for any purpose with or without fee is hereby granted
isc | 0.8 | the software is provided ["'“]?as is["'”]? and the author disclaims all warranties
bsd-1-clause | 0.8 | redistributions of source code must retain the above copyright notice
bsd-2-clause-freebsd | 0.9 | the views and conclusions contained in the software and documentation are those of the authors
bsd-2-clause-patent | 1.0 | each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual
bsd-3-clause-attribution | 0.9 | redistributions of any form whatsoever must retain the following acknowledgments?
bsd-3-clause-lbnl | 0.9 | you are under no obligation whatsoever to provide any bug fixes, patches, or upgrades
bsd-3-clause-no-nuclear | 1.0 | not designed, licensed or intended for use in the design, construction, operation or maintenance of any nuclear facility
bsd-4-clause-uc | 0.9 | this product includes software developed by the university of california,? berkeley
bsd-source-code | 0.8 | redistributions of source code in source code form must retain
bsd-protection | 0.9 | bsd protection licen[sc]e
bsd-systemics | 0.9 | systemics bsd variant
apache-1.0 | 0.9 | this product includes software developed by the apache group for use in the apache http server
apache-1.1 | 0.8 | the names ["'“]?apache["'”]? and ["'“]?apache software foundation["'”]? must not be used to endorse
apache-2.0 | 0.9 | each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license
apache-2.0 | 0.9 | you must cause any modified files to carry prominent notices stating that you changed the files
apache-2.0-llvm-exception | 1.0 | llvm exceptions? to the apache 2\.0 license
apache-2.0-swift-exception | 1.0 | runtime library exception to the apache 2\.0 license
gpl-1.0-or-later | 1.0 | either version 1,? or \(at your option\) any later version
gpl | 0.8 | this general public license does not permit incorporating your program into proprietary programs
gpl | 0.8 | the licenses for most software are designed to take away your freedom to share and change it
gpl-3.0 | 0.9 | the gnu general public license is a free, copyleft license for software and other kinds of works
gpl-3.0 | 0.8 | no covered work shall be deemed part of an effective technological measure
gpl-2.0 | 0.8 | you may not copy, modify, sublicense, or distribute the program except as expressly provided under this license
gpl-2.0 | 0.8 | activities other than copying, distribution and modification are not covered by this license
gpl-classpath | 0.9 | the copyright holders of this library give you permission to link this library with independent modules
gpl-openssl | 0.9 | permission to link the code of (?:this program|portions of this program) with the openssl library
gpl-foss | 0.9 | (?:foss|floss) licen[sc]e exception
gpl-universal-foss | 0.9 | universal foss exception
gpl-linux-syscall | 1.0 | this copyright does \*?not\*? cover user programs that use kernel services
gpl-qt | 0.9 | qt gpl exception
gpl-u-boot | 0.9 | u-boot exception
gpl-wxwindows | 0.9 | wxwindows library licen[sc]e
lgpl-2.1-or-later | 1.0 | either version 2\.1 of the license,? or \(at your option\) any later version
lgpl-2.1 | 0.8 | a ["'“]?work that uses the library["'”]?
lgpl-3.0 | 0.9 | this version of the gnu lesser general public license incorporates the terms and conditions of version 3
agpl-3.0 | 0.9 | all users interacting with it remotely through a computer network
agpl-3.0 | 0.9 | the gnu affero general public license is a free, copyleft license for software and other kinds of works
gfdl | 0.9 | with no invariant sections, no front-cover texts,? and no back-cover texts
mpl-2.0 | 0.9 | if a copy of the mpl was not distributed with this file
mpl-1.1 | 0.8 | software distributed under the license is distributed on an ["'“]?as is["'”]? basis
epl-1.0 | 1.0 | made available under the terms of the eclipse public license v1\.0
epl-2.0 | 0.9 | this source code may also be made available under the following secondary licenses
cddl-1.0 | 0.9 | you can obtain a copy of the license at usr/src/opensolaris\.license
cddl | 0.9 | when distributing covered code, include this cddl header notice
eupl | 0.9 | licensed under the eupl
eupl-1.2 | 0.9 | licence publique de l'union européenne
artistic-1.0 | 0.9 | the intent of this document is to state the conditions under which a package may be copied
artistic-2.0 | 0.9 | everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed\.? preamble this license establishes the terms
artistic-clarified | 0.9 | clarified artistic licen[sc]e
bsl | 0.9 | permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation
busl-1.1 | 0.9 | the licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use
busl-1.1 | 0.9 | additional use grant
sspl | 0.9 | making the functionality of the program or modified version available to third parties as a service
elastic-2.0 | 0.9 | you may not provide the software to third parties as a hosted or managed service
commons-clause | 0.9 | the grant of rights under the license will not include, and the license does not grant to you, the right to sell the software
polyform-internal-use | 1.0 | polyform internal use licen[sc]e
polyform-free-trial | 1.0 | polyform free trial licen[sc]e
polyform-perimeter | 1.0 | polyform perimeter licen[sc]e
polyform-strict | 1.0 | polyform strict licen[sc]e
fsl | 1.0 | functional source licen[sc]e
fair-source | 0.9 | fair source licen[sc]e
timescale | 0.9 | timescale licen[sc]e
redis-sal | 0.9 | redis source available licen[sc]e
mariadb-bsl | 0.9 | mariadb business source licen[sc]e
zlib | 0.9 | altered source versions must be plainly marked as such
zlib | 0.8 | the origin of this software must not be misrepresented
zlib-acknowledgement | 0.9 | zlib/libpng license with acknowledgement
libpng | 0.9 | the png reference library is supplied ["'“]?as is
bzip2 | 0.9 | bzip2(?: and libbzip2)? licen[sc]e
unlicense | 0.9 | anyone is free to copy, modify, publish, use, compile, sell, or distribute this software
wtfpl | 0.9 | everyone is permitted to copy and distribute verbatim or modified copies of this license document
ofl | 0.9 | the fonts and derivatives, however, cannot be released under any other type of license
ofl | 0.9 | neither the font software nor any of its individual components
arphic | 0.9 | arphic public licen[sc]e
ipa | 0.9 | ipa font licen[sc]e
bitstream-vera | 0.8 | the font software may be modified, altered, or added to
stix-fonts | 0.9 | stix fonts? user licen[sc]e
python-2.0 | 0.9 | psf hereby grants licensee a nonexclusive, royalty-free, world-wide license
python-cnri | 0.9 | cnri (?:open source gpl-compatible )?license agreement
python-bsd | 0.8 | beopen\.com (?:python open source )?license agreement
ruby | 0.9 | you may make and give away verbatim copies of the source form of the software without restriction
php-3.0 | 0.9 | this product includes php software, freely available from
zpl | 0.9 | zope public licen[sc]e
openssl | 0.9 | the names ["'“]?openssl toolkit["'”]? and ["'“]?openssl project["'”]? must not be used
ssleay | 0.9 | this package is an ssl implementation written by eric young
curl | 0.8 | copyright and permission notice copyright .{1,80}? daniel stenberg
postgresql | 0.9 | permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted
tcl | 0.9 | tcl/tk licen[sc]e
tcl | 0.9 | the authors hereby grant permission to use, copy, modify, distribute, and license this software and its documentation
ncsa | 0.9 | developed by: .{1,120}? university of illinois
afl-3.0 | 0.9 | licensed under the academic free license version 3\.0
osl-3.0 | 0.9 | licensed under the open software license version 3\.0
cpal | 1.0 | common public attribution licen[sc]e
rpl | 0.9 | reciprocal public licen[sc]e
cua | 0.9 | cua office public licen[sc]e
nokia | 0.9 | nokia open source licen[sc]e
motosoto | 0.9 | motosoto open source licen[sc]e
frameworx | 0.9 | frameworx (?:open )?licen[sc]e
fair | 0.8 | usage of the works is permitted provided that this instrument is retained with the works
naumen | 0.9 | naumen public licen[sc]e
ngpl | 0.9 | nethack general public licen[sc]e
oclc | 0.9 | oclc research public licen[sc]e
realnetworks | 0.9 | realnetworks public source licen[sc]e
ricoh | 0.9 | ricoh source code public licen[sc]e
sissl | 0.9 | sun industry standards source licen[sc]e
simpl | 0.9 | simple public licen[sc]e
sleepycat | 0.9 | sleepycat (?:software product )?licen[sc]e
sleepycat | 0.9 | redistributions in any form must be accompanied by information on how to obtain complete source code
sybase | 0.9 | sybase open watcom public licen[sc]e
vsl | 0.9 | vovida software licen[sc]e
watcom | 0.8 | open watcom public licen[sc]e
xnet | 0.9 | x\.net,? inc\.? licen[sc]e
entessa | 0.9 | entessa public licen[sc]e
eiffel | 0.9 | eiffel forum licen[sc]e
eu-datagrid | 0.9 | eu datagrid software licen[sc]e
lpl | 0.9 | lucent public licen[sc]e
liliq | 0.9 | licence libre du québec
cecill | 0.9 | ce logiciel est régi par la licence cecill
cecill | 0.9 | this software is governed by the cecill(?:-[bc])? license under french law
cecill-b | 1.0 | cecill-b(?: free software)? licen[sc]e
cecill-c | 1.0 | cecill-c(?: free software)? licen[sc]e
miros | 0.8 | provided that these terms and disclaimer and all copyright notices are retained or reproduced
multics | 0.9 | multics licen[sc]e
nasa | 1.0 | nasa open source agreement
oset | 0.9 | oset public licen[sc]e
osc | 0.8 | open source community licen[sc]e
openldap | 1.0 | openldap public licen[sc]e
oracle-bcl | 0.9 | oracle binary code licen[sc]e
oracle-otn | 0.9 | oracle technology network licen[sc]e
upl | 0.9 | subject to the condition set forth below, permission is hereby granted to any person obtaining a copy of this software, associated documentation and/or data
apsl | 0.9 | this file contains original code and/or modifications of original code as defined in and that are subject to the apple public source license
apple-sample | 0.9 | apple inc\. \(["'“]?apple["'”]?\) in consideration of your agreement to the following terms
ms-pl | 0.9 | the terms ["'“]?reproduce,["'”]? ["'“]?reproduction,["'”]? ["'“]?derivative works,["'”]? and ["'“]?distribution["'”]? have the same meaning here as under u\.s\. copyright law
ms-lpl | 0.9 | microsoft limited public licen[sc]e
ms-eula | 0.9 | microsoft software licen[sc]e terms
lppl-1.3 | 1.0 | conditions of the latex project public license, either version 1\.3
lppl | 0.9 | this work has the lppl maintenance status
w3c | 0.9 | by obtaining, using and/or copying this work, you \(the licensee\) agree
vim | 0.8 | vim is charityware
beerware | 0.9 | if we meet some day, and you think this stuff is worth it, you can buy me a beer
mulan-psl-2.0 | 0.9 | you can use this software according to the terms and conditions of the mulan psl v2
blueoak | 0.9 | each contributor licenses you to do everything with this software that would otherwise infringe
unicode | 0.9 | permission is hereby granted, free of charge, to any person obtaining a copy of the unicode data files
icu | 0.8 | to deal in the software without restriction, .{1,120}? provided that the above copyright notice\(s\) and this permission notice appear in all copies
imagemagick | 0.8 | copyright .{1,80}? imagemagick studio llc
freetype | 1.0 | (?:the )?freetype (?:project )?licen[sc]e
ftl | 0.9 | portions of this software are copyright .{1,60}? the freetype project
fsf-all-permissive | 0.9 | copying and distribution of this file, with or without modification, are permitted in any medium without royalty
fsf-unlimited | 0.9 | this configure script is free software; the free software foundation gives unlimited permission
gnuplot | 0.9 | permission to modify the software is granted, but not the right to distribute the complete modified source code
doc | 0.8 | ace\(tm\), tao\(tm\)
boehm-gc | 0.9 | provided the above notices are retained on all copies
info-zip | 1.0 | info-zip licen[sc]e
info-zip | 0.9 | for the purposes of this copyright and license, ["'“]?info-zip["'”]? is defined as
unrar | 1.0 | unrar (?:sources? )?(?:license|cannot be used to re-?create the rar compression algorithm)
7zip | 0.8 | 7-zip licen[sc]e
nvidia | 0.8 | any use, reproduction, disclosure or distribution of this software and related documentation without an express license agreement from nvidia
intel | 0.8 | intel open source licen[sc]e
openrail | 0.9 | use-based restrictions as referenced in paragraph 5
openrail | 0.9 | bigcode open\s?rail-m
llama-2 | 0.9 | if you use the llama materials to create, train, fine tune, or otherwise improve an ai model
llama-3 | 0.9 | built with (?:meta )?llama 3
llama-4 | 1.0 | llama 4 community licen[sc]e
falcon | 0.9 | falcon (?:180b )?(?:tii )?licen[sc]e
qwen | 0.9 | (?:tongyi )?qianwen licen[sc]e agreement
deepseek | 0.9 | deepseek (?:model )?licen[sc]e
mistral-research | 1.0 | mistral ai research licen[sc]e
stability | 0.9 | stability ai (?:community|non-commercial research community) licen[sc]e
yi | 0.9 | yi series models community licen[sc]e
cc-by-2.0 | 1.0 | creativecommons\.org/licenses/by/2\.0
cc-by-2.5 | 1.0 | creativecommons\.org/licenses/by/2\.5
cc-by-sa-2.0 | 1.0 | creativecommons\.org/licenses/by-sa/2\.0
cc-by-sa-2.5 | 1.0 | creativecommons\.org/licenses/by-sa/2\.5
cc-by-nc-2.0 | 1.0 | creativecommons\.org/licenses/by-nc/2\.0
cc-by-nc-3.0 | 1.0 | creativecommons\.org/licenses/by-nc/3\.0
cc-by-nd-3.0 | 1.0 | creativecommons\.org/licenses/by-nd/3\.0
cc-by-nc-sa-3.0 | 1.0 | creativecommons\.org/licenses/by-nc-sa/3\.0
cc-by-nc-nd-3.0 | 1.0 | creativecommons\.org/licenses/by-nc-nd/3\.0
cc-sampling | 1.0 | creativecommons\.org/licenses/sampling
cc-devnations | 1.0 | creativecommons\.org/licenses/devnations
cc-by | 0.8 | this work is licensed under a creative commons attribution
cc-by-sa | 0.9 | text is available under the creative commons attribution-share\s?alike licen[sc]e
cc0-1.0 | 0.9 | to the extent possible under law, .{1,160}? has waived all copyright
public-domain | 0.8 | the author\(?s?\)? disclaims? copyright to this source code
public-domain | 0.8 | placed in the public domain
public-domain | 0.8 | this is a work of the (?:u\.s\.|united states) government
odbl | 0.9 | contains information from .{1,120}? which is made available here under the open database license
dbcl | 1.0 | database contents licen[sc]e
ogl-canada | 1.0 | contains information licensed under the open government licen[sc]e
nlod | 1.0 | norwegian licence for open government data
etalab | 0.9 | etalab open licen[sc]e
gnu-verbatim | 0.9 | verbatim copying and distribution of this entire article (?:is|are) permitted
opl | 0.9 | open publication licen[sc]e
dsl | 0.9 | design science licen[sc]e
against-drm | 0.9 | against drm licen[sc]e
hippocratic | 1.0 | hippocratic licen[sc]e
anti-996 | 1.0 | anti[\s-]996 licen[sc]e
cooperative-nonviolent | 1.0 | (?:cooperative nonviolent public|anti-capitalist software) licen[sc]e
cern-ohl | 1.0 | cern open hardware licen[sc]e
tapr-ohl | 1.0 | tapr open hardware licen[sc]e
solderpad | 1.0 | solderpad hardware licen[sc]e
ogl-wotc | 1.0 | open game licen[sc]e
proprietary | 0.8 | this (?:software|document) contains (?:proprietary|confidential) information of
proprietary | 0.8 | no part of this (?:publication|book|document|work) may be reproduced
proprietary | 0.8 | by installing(?:,? copying)? or (?:otherwise )?using (?:the|this) software,? you agree to be bound
proprietary | 0.8 | you may not reverse[\s-]engineer, decompile,? or disassemble
proprietary | 0.8 | for (?:personal|evaluation|internal) use only
proprietary | 0.7 | tutti i diritti riservati
proprietary | 0.7 | todos os direitos reservados
proprietary | 0.7 | alle rechten voorbehouden
"""
#: Priority of signatures; among the forms of names it lies between grants and identifiers.
SIGNED = 45

_GRANT = r"(?:licensed|released|distributed|available|published)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?"
#: Templates around a name {n}, a short form {s} and a version {v}: without and with the version; priority and confidence.
TEMPLATES = (
    (r"spdx-licen[sc]e-identifier:\s*{s}", r"spdx-licen[sc]e-identifier:\s*{s}-{v}(?:-only|-or-later|\+)?", 50, 1.0),
    (_GRANT + r"(?:{n}|{s})", _GRANT + r"(?:{n}|{s}),?\s+(?:version|v)?\.?\s*{v}", 40, 0.95),
    (None, r"{n}(?:,?\s+(?:version|v)\.?\s*|\s+){v}", 30, 0.85),
    (r"licen[sc]e:\s*(?:{n}|{s})", r"licen[sc]e:\s*(?:{n}|{s})[\s-]+v?{v}", 25, 0.8),
    (r"{n}", None, 10, 0.6),
)


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    priority: int
    confidence: float
    pattern: re.Pattern
    #: Of each set, every match holds a member.
    needs: tuple[frozenset[str], ...]


def literals(parsed: Iterable) -> list[frozenset[str]]:
    """Sets of literals of a parsed pattern, of each of which every match holds one: runs of characters, and one run of each alternative."""
    out, run = [], ""
    for kind, value in [*parsed, (None, None)]:
        if kind is op.LITERAL:
            run += chr(value)
            continue
        if len(run) > 1:
            out.append(frozenset((run,)))
        run = ""
        if kind is op.SUBPATTERN:
            out += literals(value[-1])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0]:
            out += literals(value[2])
        elif kind is op.BRANCH:
            each = [literals(x) for x in value[1]]
            if all(each):
                out.append(frozenset().union(*(max(x, key=lambda s: min(map(len, s))) for x in each)))
    return out


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, in order: signatures, then each family's versioned forms and its bare forms, by template."""
    made: list[Rule] = []

    def add(label: str, priority: int, confidence: float, text: str) -> None:
        text = r"(?<![a-z0-9])" + text + r"(?![a-z])"
        made.append(Rule(len(made), label, priority, confidence, re.compile(text, re.S), tuple(literals(_parser.parse(text, re.S)))))

    for line in SIGNATURES.strip().split("\n"):
        label, confidence, text = line.split(" | ")
        add(label, SIGNED, float(confidence), text.replace(" ", r"\s+"))
    for label, name, versions, short in FAMILIES:
        for version in (*versions, None):
            for bare, versioned, priority, confidence in TEMPLATES:
                template = versioned if version else bare
                if template is None:
                    continue
                number = re.escape((version or "").removesuffix(".0")) + (r"(?:\.0)?" if (version or "").endswith(".0") else "") + r"(?![0-9]|\.[0-9])"
                text = template.replace("{n}", f"(?:{name})").replace("{s}", f"(?:{short})(?![a-z0-9])").replace("{v}", number)
                add(label + (f"-{version}" if version else ""), priority + 2 * bool(version) + ("-" in label), confidence, text)
    return tuple(made)


@cache
def automaton() -> ahocorasick.Automaton:
    """Finds every literal that a rule needs."""
    found = ahocorasick.Automaton()
    for word in {w for r in rules() for need in r.needs for w in need}:
        found.add_word(word, word)
    found.make_automaton()
    return found


@cache
def by_rarest() -> dict[str, list[Rule]]:
    """Rules by the members of that one of their sets whose members are longest; rules without sets under ''."""
    out: dict[str, list[Rule]] = {}
    for rule in rules():
        for word in max(rule.needs, key=lambda s: min(map(len, s)), default=("",)):
            out.setdefault(word, []).append(rule)
    return out


def detections(text: str, gated: bool = True) -> list[tuple[int, int, Rule]]:
    """Detections in a lower-cased text that stand, by place. Those that lie within another of the same or higher priority go;
    of equal intervals the earlier rule stands. The gate passes over rules whose literals the text lacks, which cannot match.
    """
    if gated:
        held = {word for _, word in automaton().iter(text)}
        index = by_rarest()
        some = {r.order: r for word in ("", *held) for r in index.get(word, ())}
        chosen = [r for _, r in sorted(some.items()) if all(need & held for need in r.needs)]
    else:
        chosen = list(rules())
    found = [(m.start(), m.end(), rule) for rule in chosen for m in rule.pattern.finditer(text)]
    found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[2].order, d[0]))
    stand: list[tuple[int, int, Rule]] = []
    starts: list[int] = []  # of the intervals that lie in no other: starts and ends both ascend
    ends: list[int] = []
    for start, end, rule in found:
        k = bisect_right(starts, start)
        if k and ends[k - 1] >= end:
            continue
        stand.append((start, end, rule))
        first = k - 1 if k and starts[k - 1] == start else k
        last = bisect_right(ends, end)
        starts[first : max(first, last)] = [start]
        ends[first : max(first, last)] = [end]
    return sorted(stand, key=lambda d: (d[0], d[1]))


def base_places(text: bytes) -> list[tuple[int, str]]:
    """(byte offset, label) of every place where a base phrase's words stand consecutively in a lower-cased text."""
    if b"license" not in text and b"cc" not in text:
        return []
    return sorted((m.start(), label) for label, last, pattern in _BASE if last in text for m in pattern.finditer(text))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A-Z is lower-cased; words are runs of ASCII letters and digits and characters beyond ASCII, in whole texts. Base
    places, their labels and word positions (from 0; null without a place) come from the fixed phrases; labels adds
    those of the rules that stand. score is 0 without a detection, else the highest confidence (a base phrase: 0.6).
    Null texts count as empty. Repeated rows, null ids and extra columns are harmless; no rows give no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 1024):
            out: list[list] = [[] for _ in range(7)]
            for text in text_bytes(batch.column("text")):
                low = text.lower()
                inside = WORD_BYTE[np.frombuffer(low, np.uint8)]
                starts = inside.copy()
                starts[1:] &= ~inside[:-1]
                places = base_places(low)
                words = [int(np.count_nonzero(starts[:at])) for at, _ in (places[:1] + places[-1:])]
                stand = detections(low.decode(errors="replace"))
                base = {label for _, label in places}
                score = max([0.6 * bool(base), *(r.confidence for _, _, r in stand)])
                row = (int(np.count_nonzero(starts)), len(places), words[0] if words else None, words[-1] if words else None, ",".join(sorted(base)), ",".join(sorted(base | {r.label for _, _, r in stand})), float(score))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double").withColumnRenamed("id", id_col)
