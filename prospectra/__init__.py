"""Prospectra: conversion analytics on Spark DataFrames and Spark ML."""
