"""Short licence notices as they stand in texts."""

TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation"
    ),
    "MIT": "Released under the MIT License",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"
    ),
}
