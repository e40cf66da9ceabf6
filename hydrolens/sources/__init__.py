"""Readers and writers: messages, images, objects, tables."""
