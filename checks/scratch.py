"""Folder for tables a check writes on its way."""

from stationcast.sources.scratch import fresh, shared_folder  # noqa: F401
