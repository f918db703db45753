"""Composite jobs and the inputs they are run on."""
