"""Signature rules of licenses: one a line, of kind, label, keywords and pattern over words.

A pattern is a regular expression whose letters are words: ``gnu?`` is an optional word, ``(lesser|library)`` a choice,
``~`` any word, ``~{0,4}`` up to four of them. Words are what ``licenses`` makes of a text: 2.0 is ``2 0``, GPL-3.0 is
``gpl 3 0``, GPLv3 is ``gplv3``. Every text that the pattern
matches has all of the keywords joined by ``+``, of those joined by ``/`` one.

Kinds, by priority: B base phrases; T wording of a license or of its notice; I identifiers; U addresses; N names; M
mentions that may mean something else.
"""

from __future__ import annotations

# priority, score of a detection
KINDS = {"T": (4, 1.0), "I": (3, 0.95), "U": (3, 0.95), "N": (2, 0.9), "B": (2, 0.9), "M": (1, 0.5)}

RULES = """
B gpl general gnu general public license
B apache apache apache license
B cc-by cc cc by
B mit mit mit license

T gpl-1.0-or-later general gnu general public license as published by the free software foundation (either version 1|version 1) or (at your option)? any later version
T gpl-2.0-or-later general gnu general public license as published by the free software foundation either version 2 ~{0,4} or (at your option)? any later version
T gpl-2.0-only general gnu general public license version 2 (only)? as published by the free software foundation
T gpl-3.0-or-later general gnu general public license as published by the free software foundation either version 3 ~{0,4} or (at your option)? any later version
T gpl-3.0-only general gnu general public license version 3 (only)? as published by the free software foundation
T gpl general you should have received a copy of the gnu general public license
T gpl redistribute this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
T gpl licensed+general this (work|program|file|software|project|document|code) is licensed under the (terms of the)? gnu general public license
T lgpl redistribute this (library|program) is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license
T lgpl-2.1-or-later lesser gnu lesser general public license as published by the free software foundation either version 2 1 ~{0,4} or (at your option)? any later version
T lgpl-3.0-or-later lesser gnu lesser general public license as published by the free software foundation either version 3 ~{0,4} or (at your option)? any later version
T lgpl lesser you should have received a copy of the gnu lesser general public license
T lgpl library you should have received a copy of the gnu library general public license
T agpl affero you should have received a copy of the gnu affero general public license
T agpl-3.0-or-later affero gnu affero general public license as published by the free software foundation either version 3 ~{0,4} or (at your option)? any later version
T gpl-3.0 copyleft the gnu general public license is a free copyleft license for software and other kinds of works
T gfdl-1.3 permission permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3
T gfdl-1.2 permission permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2
T gfdl permission permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
T apache-2.0 licensed licensed under the apache license version 2 0
T apache-2.0 compliance you may not use this file except in compliance with the license you may obtain a copy of the license at
T apache-2.0 warranties distributed on an as is basis without warranties or conditions of any kind
T apache-2.0 contributor each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (copyright|patent)
T apache-1.1 apache this product includes software developed by the apache software foundation
T mit permission permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
T mit notice the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
T mit noninfringement merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable
T mit mit+license (released|distributed|published|available|licensed) under the (terms of the)? mit license
T mit-0 permission permission is hereby granted free of charge to any person obtaining a copy of this software ~{0,3} to deal in the software without restriction including ~{0,20} to permit persons to whom the software is furnished to do so the software is provided as is
T bsd-2-clause redistribution redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
T bsd-3-clause neither neither the name of ~{1,12} may be used to endorse or promote products derived from this software
T bsd-4-clause advertising all advertising materials mentioning features or use of this software must display the following acknowledgement
T bsd contributors this software is provided by the (copyright holders|author|authors|regents) and contributors as is
T bsd bsd+style+license (use of this source code is governed|governed) by a bsd style license
T 0bsd permission permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
T isc permission permission to use copy modify and (or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
T hpnd permission permission to use copy modify and distribute this software and its documentation for any purpose ~{0,4} without fee is hereby granted
T zlib altered altered source versions must be plainly marked as such and must not be misrepresented as being the original software
T zlib express this software is provided as is without any express or implied warranty in no event will the authors be held liable
T bsl-1.0 permission permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
T unlicense unencumbered this is free and unencumbered software released into the public domain
T wtfpl fuck do what the fuck you want to public license
T wtfpl fuck you just do what the fuck you want to
T mpl-1.1 contents the contents of this file are subject to the mozilla public license version 1 1
T mpl-2.0 subject this source code form is subject to the terms of the mozilla public license (v 2 0|version 2 0|v2 0)
T mpl-2.0 incompatible this source code form is incompatible with secondary licenses as defined by the mozilla public license
T epl-1.0 materials this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
T epl-2.0 materials this program and the accompanying materials are made available under the terms of the eclipse public license (v 2 0|v2 0|2 0)
T cddl-1.0 common the contents of this file are subject to the terms of the common development and distribution license
T cpl-1.0 common the accompanying program is provided under the terms of this common public license
T artistic-2.0 artistic everyone is permitted to copy and distribute verbatim copies of this license document ~{0,12} the artistic license 2 0
T perl perl you may (redistribute|distribute) it and or modify it under the same terms as perl itself
T perl perl this (library|program|module) is free software you can redistribute it and or modify it under the same terms as perl
T python-2.0 python psf is making python available to licensee on an as is basis
T openssl openssl this product includes software developed by the openssl project for use in the openssl toolkit
T php-3.01 php this product includes php software freely available from
T ofl-1.1 font this font software is licensed under the sil open font license
T ofl-1.1 reserved no modified version of the font software may use the reserved font name
T cc0-1.0 deed the person who associated a work with this deed has dedicated the work to the public domain
T cc0-1.0 waived to the extent possible under law ~{1,12} has waived all copyright
T cc-by licensed licensed under a creative commons attribution ~{0,2} (international|unported|generic)? license
T cc-by-sa licensed licensed under (a|the) creative commons attribution (sharealike|share alike) ~{0,3} license
T cc-by-nc licensed licensed under (a|the) creative commons attribution (noncommercial|non commercial) ~{0,3} license
T cc-by-nc licensed licensed under cc by nc (4 0|3 0|2 5|2 0)?
T cc-by-sa licensed licensed under cc by sa (4 0|3 0|2 5|2 0)?
T cc-by-nd licensed licensed under cc by nd (4 0|3 0|2 5|2 0)?
T cc-by-nc-sa licensed licensed under cc by nc sa (4 0|3 0|2 5|2 0)?
T cc-by-nc-nd licensed licensed under cc by nc nd (4 0|3 0|2 5|2 0)?
T public-domain public+domain (this work|this file|this software|this code|it) (is|has been) (released|dedicated|placed|put) (into|to|in) the public domain
T public-domain copyright the author disclaims copyright to this source code
T commercial confidential this software is the confidential and proprietary information of
T commercial proprietary this software is proprietary (and confidential)? unauthorized (copying|use|reproduction) ~{0,12} (is strictly prohibited|prohibited)
T commons-clause commons the license does not include and the license does not grant to you the right to sell the software ~{0,30} commons clause
T sspl-1.0 service if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available
T busl-1.1 change (change date|change license) ~{1,12} (change license|additional use grant)
T json evil the software shall be used for good not evil
T beerware beer if we meet some day and you think this stuff is worth it you can buy me a beer
T curl curl permission to use copy modify and distribute this software for any purpose ~{0,30} curl license
T ms-pl microsoft this license governs use of the accompanying software ~{0,30} microsoft public license
T eupl-1.2 european/eupl licensed under the (eupl|european union public licence) (v 1 2|v1 2|version 1 2|1 2)
T cecill cecill this software is governed by the cecill license under french law
T nvidia nvidia nvidia corporation and its licensors retain all intellectual property and proprietary rights
T odbl open+database+license this ~{1,8} is made available under the open database license
T llama-community llama is licensed under the llama (2|3|3 1|3 2)? community license

I gpl-1.0 spdx spdx license identifier gpl 1 0 (only|or later)?
I gpl-2.0-only spdx spdx license identifier gpl 2 0 (only)?
I gpl-2.0-or-later spdx spdx license identifier gpl 2 0 or later
I gpl-3.0-only spdx spdx license identifier gpl 3 0 (only)?
I gpl-3.0-or-later spdx spdx license identifier gpl 3 0 or later
I lgpl-2.1 spdx spdx license identifier lgpl 2 1 (only|or later)?
I lgpl-2.0 spdx spdx license identifier lgpl 2 0 (only|or later)?
I lgpl-3.0 spdx spdx license identifier lgpl 3 0 (only|or later)?
I agpl-3.0 spdx spdx license identifier agpl 3 0 (only|or later)?
I gfdl spdx spdx license identifier gfdl 1 (1|2|3) (only|or later)?
I apache-2.0 spdx spdx license identifier apache 2 0
I apache-1.1 spdx spdx license identifier apache 1 1
I mit spdx spdx license identifier mit
I mit-0 spdx spdx license identifier mit 0
I bsd-2-clause spdx spdx license identifier bsd 2 clause
I bsd-3-clause spdx spdx license identifier bsd 3 clause
I bsd-4-clause spdx spdx license identifier bsd 4 clause
I 0bsd spdx spdx license identifier 0bsd
I isc spdx spdx license identifier isc
I zlib spdx spdx license identifier zlib
I bsl-1.0 spdx spdx license identifier bsl 1 0
I unlicense spdx spdx license identifier unlicense
I wtfpl spdx spdx license identifier wtfpl
I mpl-1.1 spdx spdx license identifier mpl 1 1
I mpl-2.0 spdx spdx license identifier mpl 2 0
I epl-1.0 spdx spdx license identifier epl 1 0
I epl-2.0 spdx spdx license identifier epl 2 0
I cddl-1.0 spdx spdx license identifier cddl 1 0
I cddl-1.1 spdx spdx license identifier cddl 1 1
I cpl-1.0 spdx spdx license identifier cpl 1 0
I artistic-2.0 spdx spdx license identifier artistic 2 0
I artistic-1.0 spdx spdx license identifier artistic 1 0
I python-2.0 spdx spdx license identifier (python|psf) 2 0
I openssl spdx spdx license identifier openssl
I ofl-1.1 spdx spdx license identifier ofl 1 1
I cc0-1.0 spdx spdx license identifier cc0 1 0
I cc-by spdx spdx license identifier cc by (4 0|3 0|2 5|2 0)
I cc-by-sa spdx spdx license identifier cc by sa (4 0|3 0|2 5|2 0)
I cc-by-nc spdx spdx license identifier cc by nc (4 0|3 0|2 5|2 0)
I cc-by-nd spdx spdx license identifier cc by nd (4 0|3 0|2 5|2 0)
I cc-by-nc-sa spdx spdx license identifier cc by nc sa (4 0|3 0|2 5|2 0)
I cc-by-nc-nd spdx spdx license identifier cc by nc nd (4 0|3 0|2 5|2 0)
I eupl-1.1 spdx spdx license identifier eupl 1 1
I eupl-1.2 spdx spdx license identifier eupl 1 2
I ms-pl spdx spdx license identifier ms pl
I ms-rl spdx spdx license identifier ms rl
I sspl-1.0 spdx spdx license identifier sspl 1 0
I busl-1.1 spdx spdx license identifier busl 1 1
I elastic-2.0 spdx spdx license identifier elastic 2 0
I upl-1.0 spdx spdx license identifier upl 1 0
I ncsa spdx spdx license identifier ncsa
I postgresql spdx spdx license identifier postgresql
I vim spdx spdx license identifier vim
I ecl-2.0 spdx spdx license identifier ecl 2 0
I osl-3.0 spdx spdx license identifier osl 3 0
I afl-3.0 spdx spdx license identifier afl 3 0
I odbl spdx spdx license identifier odbl 1 0
I blueoak-1.0.0 spdx spdx license identifier blueoak 1 0 0
I gpl-2.0 osi license osi approved gnu general public license v2 (gplv2)?
I gpl-3.0 osi license osi approved gnu general public license v3 (gplv3)?
I mit osi license osi approved mit license
I apache-2.0 osi license osi approved apache software license
I bsd osi license osi approved bsd license
I mpl-2.0 osi license osi approved mozilla public license 2 0

U gpl-2.0 gnu gnu org licenses (old licenses)? gpl 2 0
U gpl-3.0 gnu gnu org licenses gpl 3 0
U gpl gnu gnu org (licenses|copyleft) gpl
U lgpl-2.1 gnu gnu org licenses (old licenses)? lgpl 2 1
U lgpl-3.0 gnu gnu org licenses lgpl 3 0
U lgpl gnu gnu org (licenses|copyleft) lgpl
U agpl-3.0 gnu gnu org licenses agpl 3 0
U agpl gnu gnu org licenses agpl
U gfdl gnu gnu org (licenses|copyleft) fdl
U apache-2.0 apache apache org licenses license 2 0
U apache-1.1 apache apache org licenses license 1 1
U mit opensource opensource org licenses mit
U bsd-2-clause opensource opensource org licenses bsd 2 clause
U bsd-3-clause opensource opensource org licenses bsd 3 clause
U apache-2.0 opensource opensource org licenses apache 2 0
U gpl-2.0 opensource opensource org licenses gpl 2 0
U gpl-3.0 opensource opensource org licenses gpl 3 0
U isc opensource opensource org licenses isc
U mpl-2.0 mozilla mozilla org (en us)? mpl 2 0
U mpl-1.1 mozilla mozilla org (en us)? mpl 1 1
U epl-1.0 eclipse eclipse org legal epl v10
U epl-2.0 eclipse eclipse org legal epl (2 0|v20)
U bsl-1.0 boost boost org license 1 0 txt
U unlicense unlicense unlicense org
U wtfpl wtfpl wtfpl net
U ofl-1.1 sil scripts sil org ofl
U cc0-1.0 creativecommons creativecommons org publicdomain zero 1 0
U public-domain creativecommons creativecommons org publicdomain mark 1 0
U cc-by creativecommons creativecommons org licenses by (4 0|3 0|2 5|2 0|1 0)
U cc-by-sa creativecommons creativecommons org licenses by sa (4 0|3 0|2 5|2 0|1 0)
U cc-by-nc creativecommons creativecommons org licenses by nc (4 0|3 0|2 5|2 0|1 0)
U cc-by-nd creativecommons creativecommons org licenses by nd (4 0|3 0|2 5|2 0|1 0)
U cc-by-nc-sa creativecommons creativecommons org licenses by nc sa (4 0|3 0|2 5|2 0|1 0)
U cc-by-nc-nd creativecommons creativecommons org licenses by nc nd (4 0|3 0|2 5|2 0|1 0)
U odbl opendatacommons opendatacommons org licenses odbl
U pddl opendatacommons opendatacommons org licenses pddl
U artistic-2.0 perlfoundation perlfoundation org artistic license 2 0

N gpl-1.0 general gnu general public license (version|v)? 1
N gpl-2.0 general gnu general public license (version|v)? (2|v2) (0)?
N gpl-2.0-or-later general gnu general public license (version|v)? (2|v2) (0)? or (any)? (later|newer)
N gpl-3.0 general gnu general public license (version|v)? (3|v3) (0)?
N gpl-3.0-or-later general gnu general public license (version|v)? (3|v3) (0)? or (any)? (later|newer)
N gpl-2.0 gpl/gplv2 (gnu)? (gpl (version|v)? (2|v2)|gplv2) (0)?
N gpl-3.0 gpl/gplv3 (gnu)? (gpl (version|v)? (3|v3)|gplv3) (0)?
N lgpl-2.0 library gnu library general public license (version|v)? (2|v2) (0)?
N lgpl-2.1 lesser gnu lesser general public license (version|v)? (2|v2) 1
N lgpl-3.0 lesser gnu lesser general public license (version|v)? (3|v3) (0)?
N lgpl lesser gnu lesser general public license
N lgpl library gnu library general public license
N lgpl-2.1 lgpl/lgplv2 (gnu)? (lgpl (version|v)? (2|v2) 1|lgplv2 1)
N lgpl-3.0 lgpl/lgplv3 (gnu)? (lgpl (version|v)? (3|v3)|lgplv3) (0)?
N agpl-3.0 affero gnu affero general public license (version|v)? (3|v3) (0)?
N agpl affero (gnu)? affero general public license
N agpl-3.0 agpl/agplv3 (gnu)? (agpl (version|v)? (3|v3)|agplv3) (0)?
N gfdl documentation gnu free documentation license (version|v)? (1 1|1 2|1 3)?
N gpl-classpath-exception classpath (gpl|license|gplv2) ~{0,4} classpath exception
N gpl-linking-exception linking (gpl|license) ~{0,4} linking exception
N apache-2.0 apache apache (software)? license (version|v)? (2|v2) (0)?
N apache-2.0 apache/apache2+license/licence/licensed (apache 2 0|apache asl 2 0|apache2) (license|licence|licensed)
N apache-1.1 apache apache (software)? license (version|v)? 1 1
N apache-1.0 apache apache (software)? license (version|v)? 1 0
N apache-2.0-llvm-exception llvm apache license v2 0 with llvm exceptions
N mit mit+license/licence/licensed (the)? mit (x11)? (license|licence)
N mit expat+license/licence/licensed expat (license|licence)
N x11 x11+license/licence/licensed x11 (license|licence)
N bsd-2-clause clause+bsd (bsd 2 clause|2 clause bsd|two clause bsd) (license|licence)?
N bsd-2-clause bsd/freebsd+license/licence/licensed (simplified bsd|freebsd) (license|licence)
N bsd-3-clause clause+bsd (bsd 3 clause|3 clause bsd|three clause bsd) (license|licence)?
N bsd-3-clause bsd+license/licence/licensed (new|modified|revised) bsd (license|licence)
N bsd-4-clause clause+bsd (bsd 4 clause|4 clause bsd) (license|licence)?
N bsd-4-clause original+bsd+license/licence/licensed original bsd (license|licence)
N bsd bsd+license/licence/licensed (the)? bsd (license|licence|licensed)
N 0bsd clause zero clause bsd
N isc isc+license/licence/licensed (the)? isc (license|licence)
N zlib zlib zlib (libpng)? (license|licence)
N bsl-1.0 boost boost software license ((version|v)? 1 0)?
N unlicense unlicense (the)? unlicense license
N mpl-1.0 mozilla mozilla public license (version|v)? 1 0
N mpl-1.1 mozilla mozilla public license (version|v)? 1 1
N mpl-2.0 mozilla mozilla public license (version|v)? (2|v2) (0)?
N mpl mozilla mozilla public license
N epl-1.0 eclipse eclipse public license (version|v|v1)? (1)? 0
N epl-2.0 eclipse eclipse public license (version|v)? (2|v2) (0)?
N epl eclipse eclipse public license
N edl-1.0 eclipse eclipse distribution license ((version|v)? 1 0)?
N cddl common common development and distribution license
N cddl cddl cddl (1 0|1 1)? (license|licence)?
N cpl-1.0 common common public license ((version|v)? 1 0)?
N ipl-1.0 ibm+license ibm public license
N artistic-1.0 artistic artistic license (version|v)? 1 0
N artistic-2.0 artistic artistic license (version|v)? 2 0
N artistic artistic (the)? artistic license
N python-2.0 python+license python software foundation license
N python-2.0 psf psf license
N openssl openssl openssl (ssleay)? license
N php php+license php license ((version|v)? 3 (0|01))?
N ruby ruby+license ruby license
N vim vim+license vim license
N postgresql postgresql postgresql license
N ncsa ncsa (university of illinois)? ncsa (open source)? license
N ofl-1.1 font sil open font license ((version|v)? 1 1)?
N ofl-1.1 ofl (sil)? ofl (version|v)? 1 1
N cc0-1.0 cc0 (cc0 1 0|cc0) (universal)? (license|public domain dedication)?
N cc-by-sa cc cc by sa ((4|3) 0)?
N cc-by-nc cc cc by nc ((4|3) 0)?
N cc-by-nd cc cc by nd ((4|3) 0)?
N cc-by-nc-sa cc cc by nc sa ((4|3) 0)?
N cc-by-nc-nd cc cc by nc nd ((4|3) 0)?
N cc-by commons creative commons attribution ((4|3) 0)?
N cc-by-sa commons creative commons attribution (sharealike|share alike) ((4|3) 0)?
N cc-by-nc commons creative commons attribution (noncommercial|non commercial) ((4|3) 0)?
N cc-by-nd commons creative commons attribution (noderivatives|noderivs|no derivatives) ((4|3) 0)?
N cc-by-nc-sa commons creative commons attribution (noncommercial|non commercial) (sharealike|share alike) ((4|3) 0)?
N cc-by-nc-nd commons creative commons attribution (noncommercial|non commercial) (noderivatives|noderivs|no derivatives) ((4|3) 0)?
N cc-zero commons creative commons zero
N eupl european european union public (licence|license) ((version|v)? 1 (1|2))?
N cecill cecill cecill (b|c)? (license|licence|2 1)
N ms-pl microsoft microsoft public license
N ms-rl microsoft microsoft reciprocal license
N sspl-1.0 server server side public license
N busl-1.1 business+license business source license ((version|v)? 1 1)?
N elastic-2.0 elastic+license elastic license ((version|v)? 2 0)?
N upl-1.0 universal+license universal permissive license ((version|v)? 1 0)?
N osl-3.0 open+software+license open software license ((version|v)? 3 0)?
N afl academic academic free license ((version|v)? (2 1|3 0))?
N ecl-2.0 educational+license educational community license ((version|v)? 2 0)?
N odbl database+license (open database|odc open database) license
N odc-by data+commons+license open data commons attribution license
N pddl domain+dedication public domain dedication and license
N ogl government+license/licence/licensed open government (licence|license) ((version|v)? (1|2|3) 0)?
N lppl latex latex project public license
N wtfpl wtfpl wtfpl (license|licence|version)?
N beerware beerware (the)? beerware license
N blueoak-1.0.0 blue+oak blue oak model license
N openrail openrail (creativeml|bigscience|bigcode)? openrail (m)? (license)?
N llama-community llama llama (2|3)? (3|3 1|3 2)? community license
N jquery jquery jquery license
N unicode unicode+license unicode (inc)? license agreement
N nasa-1.3 nasa nasa open source agreement
N cpal-1.0 common+attribution common public attribution license (1 0)?
N cpal-1.0 cpal cpal (1 0)?
N qpl-1.0 public+license q public license
N sleepycat sleepycat sleepycat license
N watcom watcom sybase open watcom public license
N rpl reciprocal+license reciprocal public license
N mulan-2.0 mulan mulan (psl|permissive software license) (v2)?

M gpl gpl (the|under|gnu) gpl (license|licence|licensed|version)?
M gpl gpl gpl (license|licence|licensed|compatible)
M lgpl lgpl (the|under|gnu)? lgpl (license|licence|licensed)?
M agpl agpl (the|under|gnu)? agpl (license|licence|licensed)?
M bsd bsd bsd (style|type|like) (license|licence)
M mit mit mit (style|type|like) (license|licence)
M cc creative+license/licence/licensed creative commons (license|licence|licensed)
M public-domain public+domain (in|into|to) the public domain
M all-rights-reserved rights+reserved all rights reserved
M commercial license/licence/licensed+commercial commercial (license|licence) (agreement)?
M commercial license/licence/licensed+proprietary proprietary (license|licence) (agreement)?
M commercial agreement+license end user license agreement
M commercial eula eula
M free-software free+software+license free software license
M open-source open+source open source (license|licence|initiative approved)
M unlicensed unlicensed (is|are) unlicensed
"""
