"""Building messages for tests."""

import json
import os
from datetime import datetime, timedelta, timezone

from wakeline.schema import EVENT, SENSORS

# Minute boundary the scripted timelines count from.
W = datetime(2026, 3, 1, 12, 0, tzinfo=timezone.utc)


def at(second):
    return W + timedelta(seconds=second)


def ms(moment):
    return int(moment.timestamp() * 1000)


def text_of(moment):
    if moment is not None:
        return moment.replace(tzinfo=None).isoformat(timespec="milliseconds") + "Z"


def message(event_id, aircraft_id, flight_id, when, **other):
    """A reading whose sensors all show their place among the sensors, a sound one by default."""
    keys = dict(zip(EVENT.fieldNames(), (event_id, aircraft_id, flight_id, text_of(when))))
    shown = {name: 100.0 * place for place, name in enumerate(SENSORS, 1)}
    return {**shown, **keys, **other}


class Topic:
    """A recorded topic in a folder; each call adds one file."""

    def __init__(self, folder):
        self.folder = folder
        folder.mkdir()
        self.files = 0
        self.next_offset = {}

    def send(self, *messages, partition=0, when=W):
        lines = []
        for text in messages:
            offset = self.next_offset.get(partition, 0)
            self.next_offset[partition] = offset + 1
            value = text if isinstance(text, str) else json.dumps(text)
            lines.append(
                json.dumps(
                    {
                        "key": "k",
                        "value": value,
                        "partition": partition,
                        "offset": offset,
                        "timestamp": text_of(when),
                    }
                )
            )
        file = self.folder / f"{self.files:06d}.json"
        file.write_text("\n".join(lines) + "\n")
        # File streams read in order of change times; keep them apart.
        changed = W.timestamp() + self.files
        os.utime(file, (changed, changed))
        self.files += 1


class Clock:
    """A clock that moves only when told."""

    def __init__(self, moment):
        self.now = ms(moment)

    def __call__(self):
        return self.now

    def moment(self):
        return datetime.fromtimestamp(self.now / 1000, timezone.utc)

    def forward(self, seconds):
        self.now += int(seconds * 1000)
